import random

import pyarrow as pa

from sparkmill.llm import streams, tokens
from sparkmill.llm.common import tokenizer_path


def test_a_slice_of_prose_is_looked_up_once(monkeypatch):
    r = random.Random(8)
    words = ["".join(r.choices("etaoinshr", k=r.randint(2, 8))) for _ in range(3000)]
    texts, size = [], 0
    while size < streams.SLICE:
        texts.append(" ".join(r.choices(words, k=400)))
        size += len(texts[-1])
    enc = tokens.Encoder(tokenizer_path("byte_bpe_50k.json"))
    asked, learnt = [], enc._learnt
    monkeypatch.setattr(enc, "_learnt", lambda pieces: (asked.append(len(pieces)), learnt(pieces))[1])
    ids, edge = enc.encode(pa.array(texts))
    assert len(asked) == 1 and len(edge) == len(texts) + 1
    for i in (0, len(texts) // 2, len(texts) - 1):
        assert ids[edge[i] : edge[i + 1]].tolist() == enc.tokenizer.encode(texts[i], add_special_tokens=False).ids
