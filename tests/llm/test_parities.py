import random

import numpy as np
import pytest

from sparkmill.llm import jaccard


def _sets(r, n):
    """Sets in ascending order of size: edited copies, sets that share a part, and others."""
    out = []
    while len(out) < n:
        a = [r.getrandbits(64) for _ in range(r.choice([1, 2, 5, 20, 60, 64, 65, 128, 129, 300]))]
        out.append(a)
        for _ in range(r.randrange(4)):
            part = r.choice([0.3, 0.8, 0.95, 1])
            out.append([x if r.random() < part else r.getrandbits(64) for x in a[: r.randint(max(1, len(a) - 9), len(a))]])
    return sorted((np.unique(np.array(x, np.uint64)) for x in out), key=len)


def _components(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        a, b = root[a], root[b]
        root = [min(a, b) if x in (a, b) else x for x in root]
    return root


@pytest.mark.parametrize("percent", [80, 90, 30])
@pytest.mark.parametrize("compared", [1 << 20, 64])
def test_no_linked_pair_is_lost(monkeypatch, percent, compared):
    monkeypatch.setattr(jaccard, "COMPARED", compared)
    r = random.Random(percent)
    for _ in range(30):
        sets = _sets(r, 40)
        pairs = jaccard.plausible(np.array([len(s) for s in sets]), [jaccard.parities(s) for s in sets], percent)
        root = _components(len(sets), pairs)
        links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))]
        assert links and all(root[i] == root[j] for i, j in links)
        assert len(pairs) == len(sets) - len(set(root))  # no more than span them


def test_sets_that_share_a_passage_are_told_apart():
    r = np.random.default_rng(3)
    common = r.integers(0, 1 << 63, 40).astype(np.uint64)
    sets = [np.unique(np.r_[common, r.integers(0, 1 << 63, 200).astype(np.uint64)]) for _ in range(300)]
    assert jaccard.plausible(np.array([len(s) for s in sets]), [jaccard.parities(s) for s in sets], 80) == []


def _documents(spark):
    """60 texts that share a passage of 40 words and are no copies, and 20 near copies of one."""
    r = random.Random(4)
    word = lambda: "w%d" % r.randrange(10**6)
    common = " ".join(word() for _ in range(40))
    texts = ["%s %s" % (common, " ".join(word() for _ in range(160))) for _ in range(60)]
    texts += [texts[0] + " " + word() for _ in range(20)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("together", [1 << 13, 7])
def test_only_plausible_sets_are_sent_whole(spark, monkeypatch, together):
    monkeypatch.setattr(jaccard, "TOGETHER", together)
    sent, materialize = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name, *x: sent.setdefault(name, materialize(df, name, *x)))
    docs = _documents(spark)
    got = {x["doc_id"]: x["component_id"] for x in jaccard.link_components(docs, 5, 80).collect()}
    assert got == {i: 0 if i == 0 or i >= 60 else i for i in range(80)}
    assert sent["sharing"].select("rep").distinct().count() > 70
    assert sent["placed"].count() == 21  # all that share a signature before


def test_a_set_of_many_signatures_is_sent_once(spark, monkeypatch):
    r = random.Random(5)
    base = ["w%d" % r.randrange(10**6) for _ in range(300)]
    texts = [" ".join("x%d" % r.randrange(10**6) if r.random() < 0.01 else w for w in base) for _ in range(40)]
    sent, materialize = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name, *x: sent.setdefault(name, materialize(df, name, *x)))
    jaccard.link_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 80).count()
    assert sent["sharing"].count() > sent["placed"].count() and sent["placed"].count() == sent["placed"].select("rep").distinct().count()
