"""Operator 13 against token spans compared one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shiftscore.llm import alignment, registry

from llm_fixtures import edge, empty  # noqa: F401
from llm_rows import edge_rows

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {**{chr(b): b for b in shown}, **{chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}}

    def spans(tokens):
        to = np.cumsum([len(t) for t in tokens])
        return [(int(t) - len(x), int(t)) for x, t in zip(tokens, to)]

    def text(t):
        if not t:
            return 0, 0, [], []
        a, b = left.encode(" " + t, add_special_tokens=False).ids, right.encode(t)
        bytes_a = [bytes(letters[c] for c in left.id_to_token(k)) for k in a]
        names = [right.id_to_piece(k) for k in b]
        bytes_b = [bytes([int(n[3:5], 16)]) if right.is_byte(k) else n.replace("▁", " ").encode() for k, n in zip(b, names)]
        if b"".join(bytes_a) != (" " + t).encode() or b"".join(bytes_b) != (" " + t).encode():
            return 0, 0, [], []
        sa, sb = spans(bytes_a), spans(bytes_b)
        groups, links, i, j = [], [], 0, 0
        for end in sorted({e for _, e in sa} & {e for _, e in sb}):
            p = next(k for k in range(i, len(sa)) if sa[k][1] == end) + 1
            q = next(k for k in range(j, len(sb)) if sb[k][1] == end) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links += [(a[x], b[y]) for x in range(i, p) for y in range(j, q) if sa[x][0] < sb[y][1] and sb[y][0] < sa[x][1]]
            i, j = p, q
        return len(a), len(b), groups, links

    return text


def corpus(plain, rows):
    """The contract's columns for rows (doc_id, text)."""
    aligned = [(d, *plain(t)) for d, t in rows]
    counts = Counter(x for *_, links in aligned for x in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(([d, na, nb, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""] for d, na, nb, groups, links in aligned), key=repr)


def odd_texts():
    rng = random.Random(4)
    letters = "ab 'slrevtmd  \n\t1.é,x'<s>|日本ёя　\U0001F600\x1c\x0b​\r\xa0²٣"
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 20, 150]))) for _ in range(400)]
    return texts + ["<|endoftext|> hi </s> <unk><0x41>", " x", "x ", "x\n", "  ", "\n", " \n ", "\t y", "é" * 50, "a▁b", "x" * 3000,
                    "word " * 3000, "12345 67", "don't we'll", "a  b   c    d\n\n e"]


def test_query_equals_plain_version_on_edge_rows(spark, edge, plain):
    df = registry.QUERIES["op13_alignment"](spark, edge)
    assert df.columns[:8] == COLUMNS
    assert sorted(([*r] for r in df.collect()), key=repr) == corpus(plain, [r[:2] for r in edge_rows()])


@pytest.mark.parametrize("chunk", [1, 5000, alignment.CHUNK_LINKS])
def test_odd_texts_in_chunks_of_any_size(spark, plain, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "LOT_CHARACTERS", 500)
    rows = [(k, t) for k, t in enumerate(odd_texts())] + [(None, "no id"), (3, "repeated id"), (3, "repeated id"), (5, None), (6, "")]
    df = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "doc_id long, text string, chunk int, links string, n_a int").repartition(3)
    table = alignment.store(alignment.aligned(df, *alignment.default_tokenizers(), chunk_links=chunk), "aligned")
    got = sorted(([*r] for r in alignment.with_counts(table).select(COLUMNS).collect()), key=repr)
    assert got == corpus(plain, rows)
    assert any(r[1] == 0 for r in got) and sum(r[1] > 0 for r in got) > 400


@pytest.mark.parametrize("piece", [1, 2, 7, 100, 1 << 16])
def test_pieces_of_the_walk(plain, monkeypatch, piece):
    monkeypatch.setattr(alignment.align, "__defaults__", (piece,))
    sides = alignment.worker_tokenizers(*alignment.default_tokenizers())
    texts = odd_texts()
    facts, a, b, to = alignment.aligned_texts(texts, sides)
    start = 0
    for t, fact, stop in zip(texts, facts, to):
        na, nb, groups, links = plain(t)
        assert fact == (na, nb, len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        assert Counter(zip(a[start:stop].tolist(), b[start:stop].tolist())) == Counter(links)
        start = stop


def test_walk_skips_runs():
    """Runs cost a logarithm of their length: lists that count their slices."""
    class Counted(list):
        def __getitem__(self, k):
            if isinstance(k, slice):
                probes.append(k)
            return list.__getitem__(self, k)

        def __add__(self, other):
            return Counted(list.__add__(self, other))

    probes = []
    ends = list(range(1, 100_001))
    other = ends[:50_000] + [50_001 - 0.5] + ends[50_000:]                 # one token is cut in two in the middle
    assert alignment.walk(Counted(ends), Counted(other)) == ([50_000, 50_001, 50_000, 50_002], 100_000, 100_001)
    assert len(probes) < 200


def test_units_equal_whole_encoding():
    sides = alignment.worker_tokenizers(*alignment.default_tokenizers())
    assert sides.by_unit
    texts = odd_texts()
    for t, got in zip(texts, sides.encode(texts)):
        a, b = sides.left.whole(t), sides.right.whole(t)
        if got is None:
            assert not sides.spell(a, b, " " + t)
        else:
            assert (got[0].tolist(), got[1].tolist()) == (a, b)
