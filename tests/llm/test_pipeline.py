"""The corpus pipeline against a plain version of its stages, on all documents of the smallest table."""

import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from shiftscore.llm import packing

from conftest import SF001
import reference as R
from test_documents import SECRET_TEXTS, plain_spans


def redacted(text):
    out, at = "", 0
    for a, _, b, _ in plain_spans(text)[1]:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_run_equals_plain_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    docs = [r.asDict() for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    some = [d for d in docs if len(d["text"]) > 900][:40]
    for k, d in enumerate(some):  # a secret, a copy that differs by case and spaces, a text without letters
        new = [f"{d['text']}\n{SECRET_TEXTS[k % len(SECRET_TEXTS)]}", d["text"].upper().replace(" ", "  "), f"{k} 123 !"][k % 3]
        docs.append(d | {"doc_id": 10_000 + k, "text": new, "n_chars": len(new)})
    spark.createDataFrame([tuple(d.values()) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(
        4).write.parquet(f"{tmp_path}/documents.parquet")
    # Language ID: what is left is prose in a labelled language, so texts with a letter stay.
    docs = [d for d in docs if any(c.isalpha() for c in d["text"])]
    prints = [R.simhash(d["text"]) for d in docs]
    ids = [d["doc_id"] for d in docs]
    least = R.least_reachable(len(docs), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 2, ids)
    docs = [d for d, c in zip(docs, least) if d["doc_id"] == c]
    text = {d["doc_id"]: redacted(d["text"]) for d in docs}
    assert any("[SECRET]" in t for t in text.values())
    times = R.mix_times([(d["doc_id"], d["source"], len(R.words(text[d["doc_id"]]))) for d in docs])
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for doc_id, n in times.items():
        x = np.array([*tokenizer.encode(text[doc_id], add_special_tokens=False).ids, 2], dtype="<u4")
        for s in range(0, len(x), 4096):
            want[(doc_id, s, len(x[s:s + 4096]), zlib.crc32(x[s:s + 4096].tobytes()), len(x))] += n
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        w.sort()
        assert w[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(w, w[1:])) and sum(w[-1]) <= 4096
    assert len(windows) <= np.ceil(sum(r.length for r in rows) / 4096) + 1
