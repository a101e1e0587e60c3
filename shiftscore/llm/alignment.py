"""Alignment of two tokenizers' cuts of the same texts.

Both token sequences of a text cover the same bytes, so an alignment is made
from their end offsets.  Where ends agree, tokens go one to one, and the two
indices differ by a constant shift: from the current pair, ever longer pieces of
the two arrays of ends are compared at that shift, doubling while they are
equal, and the last doubled piece is halved down to the exact place where the
run stops.  The irregular group that follows is walked token by token until two
ends meet, which gives the new shift.

Texts are encoded one by one, and a lot of them is walked as one, in pieces of
bounded length: both sides end together at the end of each text.
Linked id pairs are counted per chunk of texts in the tasks, then over the
corpus in a shuffle of distinct (chunk, pair) rows, and each chunk gets the
counts of its own pairs back, so neither the pair counts nor the texts pass
through one task or the driver, and a pair is there once per chunk at most.

Edge cases: a NULL or empty text, or one whose tokens don't spell a space and
the text (such as a vocabulary that drops characters), has no tokens: zeros and
'' as digest.  Repeated rows are aligned one by one; an empty table gives no
row; texts are encoded whole; all other columns are left out of the result.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import documents, store, text_batches

#: Links after which a chunk is full.
CHUNK_LINKS = 1 << 20
#: Characters of texts that are walked as one, if they aren't one longer text.
LOT_CHARACTERS = 200_000
#: Tokens of one side that are walked at a time.
PIECE = 1 << 16
#: Units a worker remembers before it starts anew, and the longest that it does; results don't depend on them.
CACHE_UNITS, LONGEST_UNIT = 300_000, 64
#: Bits of the right id in a pair.
PAIR_BITS = 32

#: Texts of these code points are cut alike by every version of Unicode and by the plain pattern below; others go through the whole tokenizers.
SETTLED = re.compile(r"[\t\n\x20-\x7E\xA1-\xA9\xAB-\xB1\xB4-\xB8\xBB\xBF-\u024F\u0391-\u03A1\u03A3-\u03C9\u0410-\u044F\u2010-\u2027\u2030-\u205E\u3041-\u3094\u30A1-\u30F6\u4E00-\u9FA5\uAC00-\uD7A3]*")
#: Units of a text: white space and what follows it. Neither side merges from other characters to white space.
UNIT = re.compile(r"\s*\S+|\s+")
#: Where a space is beside other white space, a text's units are not simply its words with the space before each.
BESIDE = ("  ", " \n", "\n ", " \t", "\t ")


class ByteLevel:
    """The left tokenizer, a byte-level one: ids of a text (a space is put before it) and the bytes of every id."""

    #: Fixed value: the pattern of byte-level vocabularies without one of their own.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        steps = json.loads(self.tokenizer.to_str())
        # Byte-level alphabet: printable bytes stand for themselves, the n-th other one for the code point 256 + n.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        back = {**{chr(b): b for b in shown}, **{chr(256 + n): b for n, b in enumerate(hidden)}}
        self.bytes = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, k in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[k] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        before, model = steps["pre_tokenizer"] or {}, steps["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [model["vocab"][a + b] for a, b in merges] if model["type"] == "BPE" else []
        # Where ids follow the order of the merges, they are the ranks that the faster encoder goes by.
        self.by_unit = (steps["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                        and not before.get("add_prefix_space") and not model.get("ignore_merges") and bool(made)
                        and made == sorted(made) and len(made) + 256 == len(model["vocab"]) - len(set(model["vocab"]) & {t["content"] for t in steps["added_tokens"]}))
        if self.by_unit:
            special = {t["id"] for t in steps["added_tokens"]}
            ranks = {b: k for k, b in enumerate(self.bytes) if k not in special}
            self.encode = tiktoken.Encoding("left", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids


class Pieces:
    """The right tokenizer, one of pieces, which puts a space before the text itself: ids and bytes of every id."""

    SPACE = "\u2581"

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace(self.SPACE, " ").encode() for n in names]
        self.lone = self.model.piece_to_id(self.SPACE)
        #: Whether a settled text's ids are those of its units: no piece goes on with white space, or from other white space to a space.
        self.by_unit = not any(re.search(r"\S[ \t\n]|[\t\n] ", n.replace(self.SPACE, " ")) for n in names) and self.model.encode("a  a") == [
            *self.unit(" a"), *self.unit("  a")]

    def unit(self, unit: str) -> list[int]:
        if unit[0] == " ":
            return self.model.encode(unit[1:]) if len(unit) > 1 else [self.lone]
        # The space that the model puts before it isn't part of this unit.
        ids, first = self.model.encode("\n" + unit), self.model.encode("\n")
        if ids[:len(first)] != first:
            raise ValueError("a unit is merged with the line end before it")
        return ids[len(first):]

    def whole(self, text: str) -> list[int]:
        return self.model.encode(text)


class Sides:
    """Both tokenizers, with the lengths and decimal texts of their ids.

    Ids of units are remembered: ``place`` has each unit's number, and the two
    lists of ids, one after the other, are cut by ``starts``.
    """

    def __init__(self, left: str, right: str):
        self.left, self.right = ByteLevel(left), Pieces(right)
        self.lengths = [np.array([len(t) for t in x.bytes], dtype=np.int64) for x in (self.left, self.right)]
        # Decimal texts of left ids before another one of their group, then before a right one; the same of right ids.
        n, m = len(self.left.bytes), len(self.right.bytes)
        names = np.array([f"{k}{mark}".encode() for size, marks in ((n, ",|"), (m, ",;")) for mark in marks for k in range(size)])
        self.names = names.view(np.uint8).reshape(len(names), -1)
        self.name_sizes = np.char.str_len(names)
        self.last_a, self.shift_b, self.last_b = n, 2 * n, m
        self.by_unit = self.left.by_unit and self.right.by_unit
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.unspelt: set[int] = set()
        self.ids = (array("I"), array("I"))
        self.starts = (array("q", [0]), array("q", [0]))

    def spell(self, a: list[int], b: list[int], text: str) -> bool:
        """Whether the bytes of both sides are those of ``text``."""
        whole = text.encode("utf-8", "surrogatepass")
        return b"".join([self.left.bytes[k] for k in a]) == whole and b"".join([self.right.bytes[k] for k in b]) == whole

    def learn(self, words: list[str]) -> None:
        """Remember units; a word without white space before it stands for the one after a space."""
        white = " \t\n"
        plain = [w for w in words if w and w[0] not in white and w[-1] not in white]
        if plain:
            # Nothing is merged or cut across from a unit to the next one's space: one call of each side encodes them all.
            text = " " + " ".join(plain)
            size = np.array([len(w.encode()) + 1 for w in plain], dtype=np.int64)
            a = np.array(self.left.encode(text), dtype=np.uint32)
            b = self.right.model.encode(plain, num_threads=1)
            count = np.array(list(map(len, b)), dtype=np.int64)
            b = np.array(list(chain.from_iterable(b)), dtype=np.uint32)
            to_a, to_b = np.searchsorted(np.cumsum(self.lengths[0][a]), np.cumsum(size)) + 1, np.cumsum(count)
            first = len(self.place)
            self.place.update(zip(plain, range(first, first + len(plain))))
            for side, (ids, to) in enumerate(((a, to_a), (b, to_b))):
                self.starts[side].frombytes((to + len(self.ids[side])).astype(np.int64).tobytes())
                self.ids[side].frombytes(ids.tobytes())
            if not self.spell(a.tolist(), b.tolist(), text) or (np.diff(np.cumsum(self.lengths[1][b])[to_b - 1], prepend=0) != size).any():
                at, bt = 0, 0
                for k, w in enumerate(plain):
                    if not self.spell(a[at:to_a[k]].tolist(), b[bt:to_b[k]].tolist(), " " + w):
                        self.unspelt.add(first + k)
                    at, bt = to_a[k], to_b[k]
        for word in words:
            if word not in self.place:
                unit = word if word and word[0] in white else " " + word
                one, two = self.left.encode(unit), self.right.unit(unit)
                if not self.spell(one, two, unit):
                    self.unspelt.add(len(self.place))
                self.place[word] = len(self.place)
                for side, ids in enumerate((one, two)):
                    self.ids[side].extend(ids)
                    self.starts[side].append(len(self.ids[side]))

    def cut(self, text: str) -> list[str] | None:
        """Words (units after one space) or units of a text, if its ids are those of its units."""
        if not (self.by_unit and SETTLED.fullmatch(text)):
            return None
        padded = " " + text
        words = UNIT.findall(padded) if text[-1] == " " or any([x in padded for x in BESIDE]) else text.split(" ")
        return words if max(map(len, words)) <= LONGEST_UNIT else None

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides of each text, or None if either doesn't spell a space and the text."""
        if not texts:
            return []
        if len(self.place) > CACHE_UNITS:
            self.forget()
        cuts = [self.cut(t) for t in texts]
        words = list(chain.from_iterable([c for c in cuts if c]))
        numbers = list(map(self.place.get, words))
        if None in numbers:
            self.learn(list({w: None for w, k in zip(words, numbers) if k is None}))
            numbers = list(map(self.place.__getitem__, words))
        units = np.array(numbers, dtype=np.int64)
        ends = np.cumsum([len(c) if c else 0 for c in cuts])
        sides = []
        for ids, starts in zip(self.ids, self.starts):
            at = np.frombuffer(starts, dtype=np.int64)
            size = at[units + 1] - at[units]
            flat = np.frombuffer(ids, dtype=np.uint32)[_spread(at[units], size)] if ids else np.empty(0, dtype=np.uint32)
            to = np.concatenate([[0], np.cumsum(size)])[ends]
            sides.append((flat, to.tolist()))
        bad = np.isin(units, list(self.unspelt)) if self.unspelt else None
        out, (a, to_a), (b, to_b) = [], *sides
        for k, (text, cut) in enumerate(zip(texts, cuts)):
            if cut and (bad is None or not bad[ends[k] - len(cut):ends[k]].any()):
                out.append((a[to_a[k - 1] if k else 0:to_a[k]], b[to_b[k - 1] if k else 0:to_b[k]]))
            else:
                one, two = self.left.whole(text), self.right.whole(text)
                out.append((np.array(one, dtype=np.uint32), np.array(two, dtype=np.uint32)) if self.spell(one, two, " " + text) else None)
        return out


@lru_cache(maxsize=1)
def worker_tokenizers(left: str, right: str) -> Sides:
    """The tokenizers of this Python worker, which serves many tasks."""
    return Sides(left, right)


#: Beyond every end: the sides' lists of ends are closed by these, which never agree.
BEYOND = 1 << 60


def walk(a: list[int], b: list[int]) -> tuple[list[int], int, int]:
    """Irregular groups of two lists of ends, ``i, i_end, j, j_end`` of each in one flat list, and where the walk ends.

    Between them, and after the last one, tokens go one to one.  A group that
    goes on beyond the lists is left out, and the walk ends before it.
    """
    odd: list[int] = []
    a, b = a + [BEYOND], b + [BEYOND + 1]
    i = j = 0
    x, y = a[0], b[0]
    while True:
        if x == y:
            step = 1
            while step < 4 and x == y:  # first probes at this shift, one by one
                step += 1
                i += 1
                j += 1
                x, y = a[i], b[j]
            if x == y:
                while a[i:i + step] == b[j:j + step]:  # doubled ones
                    i += step
                    j += step
                    step += step
                step >>= 1
                while step:  # the run stops within the last one
                    if a[i:i + step] == b[j:j + step]:
                        i += step
                        j += step
                    step >>= 1
                x, y = a[i], b[j]
        p, q = i, j
        while x != y:
            if x < y:
                if y >= BEYOND:
                    return odd, i, j
                p += 1
                x = a[p]
            else:
                if x >= BEYOND:
                    return odd, i, j
                q += 1
                y = b[q]
        p += 1
        q += 1
        odd += i, p, j, q
        i, j, x, y = p, q, a[p], b[q]


def align(ends_a: np.ndarray, ends_b: np.ndarray, piece: int = PIECE) -> Iterator[tuple[int, int, np.ndarray]]:
    """Groups of both sides' ends by pieces that follow one another without a gap: the first index of each side, then
    rows ``i, i_end, j, j_end`` from there on.

    A run of one-to-one tokens is one row, whose tokens are a group each; an
    irregular group has ``~j`` in place of ``j``.
    """
    at, bt, size = 0, 0, piece
    while at < len(ends_a):
        flat, i, j = walk(ends_a[at:at + size].tolist(), ends_b[bt:bt + size].tolist())
        if not i:  # one group is longer than the piece
            size *= 2
            continue
        odd = np.array(flat, dtype=np.int64).reshape(-1, 4)
        groups = np.empty((2 * len(odd) + 1, 4), dtype=np.int64)
        groups[1::2] = odd
        groups[::2, 0], groups[::2, 2] = np.r_[0, odd[:, 1]], np.r_[0, odd[:, 3]]
        groups[::2, 1], groups[::2, 3] = np.r_[odd[:, 0], i], np.r_[odd[:, 2], j]
        groups[1::2, 2] = ~odd[:, 2]
        yield at, bt, groups[(groups[:, 2] < 0) | (groups[:, 1] > groups[:, 0])]
        at, bt, size = at + i, bt + j, piece


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of each range, one after the other."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def links_of(groups: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of tokens that share a byte.

    Tokens of a run are linked one to one.  In irregular groups every stretch
    between two neighbouring ends of either side lies in one token of each.
    """
    run = groups[:, 2] >= 0
    one, odd = groups[run], groups[~run]
    size = one[:, 1] - one[:, 0]
    odd_a, odd_b = _spread(odd[:, 0], odd[:, 1] - odd[:, 0]), _spread(~odd[:, 2], odd[:, 3] - ~odd[:, 2])
    stop_a, stop_b = ends_a[odd_a], ends_b[odd_b]
    stops = np.sort(np.concatenate([stop_a, stop_b]), kind="stable")
    stops = stops[np.r_[True, stops[1:] != stops[:-1]]] if len(stops) else stops
    return (np.concatenate([_spread(one[:, 0], size), odd_a[np.searchsorted(stop_a, stops)]]),
            np.concatenate([_spread(one[:, 2], size), odd_b[np.searchsorted(stop_b, stops)]]))


def group_ends(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where every single group ends on both sides; each token pair of a run is one."""
    run = groups[:, 2] >= 0
    many = np.where(run, groups[:, 1] - groups[:, 0], 1)
    on = np.repeat(run, many) * (_spread(np.zeros(len(many), dtype=np.int64), many) + 1)
    return tuple(np.repeat(np.where(run, groups[:, c], groups[:, c + 1]), many) + on for c in (0, 2))


def spelt(ids_a: np.ndarray, ids_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, sides: "Sides") -> tuple[bytes, np.ndarray]:
    """Groups as text, ``a1,a2|b1;a3|b2,b3;``, and where the text of each group ends."""
    size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    # A token's place among all: those of its own side before it, and those of whole groups of the other side.
    place_a = np.arange(len(ids_a)) + np.repeat(end_b - size_b, size_a)
    place_b = np.arange(len(ids_b)) + np.repeat(end_a, size_b)
    code = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    named_a, named_b = ids_a.astype(np.int64), ids_b.astype(np.int64) + sides.shift_b
    named_a[end_a - 1] += sides.last_a
    named_b[end_b - 1] += sides.last_b
    code[place_a], code[place_b] = named_a, named_b
    letters = sides.names[code].ravel()
    return letters[letters != 0].tobytes(), np.cumsum(sides.name_sizes[code])[end_a + end_b - 1]


NOTHING = (0, 0, 0, 0, "")


def aligned_texts(texts: list[str | None], sides: "Sides") -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """``n_a, n_b, n_groups, n_links, digest`` of every text, the ids of all links, text by text, and where each text's end.

    The texts are walked as one: both sides end together at the end of every
    text, so no group goes beyond it.
    """
    encoded = iter(sides.encode([t for t in texts if t]))
    both = [next(encoded) if t else None for t in texts]
    none = np.empty(0, dtype=np.uint32)
    a, b = [np.concatenate([none, *[x[side] for x in both if x is not None]]) for side in (0, 1)]
    stop_a, stop_b = [np.cumsum([0 if x is None else len(x[side]) for x in both]) for side in (0, 1)]
    ends_a, ends_b = np.cumsum(sides.lengths[0][a]), np.cumsum(sides.lengths[1][b])
    digests = [hashlib.sha256() if x is not None else None for x in both]
    n_groups, n_links = np.zeros(len(both), dtype=np.int64), np.zeros(len(both), dtype=np.int64)
    link_a, link_b = [none], [none]
    for at, bt, groups in align(ends_a, ends_b):
        to, bo = at + groups[-1, 1], bt + groups[-1, 3]
        end_a, end_b = group_ends(groups)
        said, said_to = spelt(a[at:to], b[bt:bo], end_a, end_b, sides)
        la, lb = links_of(groups, ends_a[at:to], ends_b[bt:bo])
        order = np.argsort(la, kind="stable")  # two sorted lists: one merge
        la, lb = la[order] + at, lb[order] + bt
        first, last = np.searchsorted(stop_a, at, "right"), np.searchsorted(stop_a, to)
        group = link = byte = 0
        for k in range(first, last + 1):  # the texts of this piece
            if both[k] is None:
                continue
            upto = min(int(stop_a[k]), to)
            groups_to, links_to = int(np.searchsorted(end_a, upto - at, "right")), int(np.searchsorted(la, upto))
            n_groups[k] += groups_to - group
            n_links[k] += links_to - link
            bytes_to = int(said_to[groups_to - 1])
            digests[k].update(said[byte:bytes_to - (upto == stop_a[k])])  # no separator after a text's last group
            group, link, byte = groups_to, links_to, bytes_to
        link_a.append(a[la])
        link_b.append(b[lb])
    facts = [NOTHING if x is None else (len(x[0]), len(x[1]), int(n_groups[k]), int(n_links[k]), digests[k].hexdigest()) for k, x in enumerate(both)]
    return facts, np.concatenate(link_a), np.concatenate(link_b), np.cumsum(n_links)


ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups_sha256", pa.string())])
CHUNKED = pa.schema([*ALIGNED, ("chunk", pa.int64()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def _index_type(pairs: int) -> str:
    return "<u2" if pairs <= 1 << 16 else "<u4"


def _chunk(ids: list, facts: list, link_a: list, link_b: list, number: int) -> pa.RecordBatch:
    """The texts of a chunk, their links as places in the chunk's list of pairs, and a row with that list."""
    pairs, place, times = np.unique((np.concatenate(link_a).astype(np.int64) << PAIR_BITS) | np.concatenate(link_b),
                                    return_inverse=True, return_counts=True)
    place = place.astype(_index_type(len(pairs)))
    out, at = [], 0
    for doc_id, fact in zip(ids, facts):
        out.append((doc_id, *fact, number, place[at:at + fact[3]].tobytes(), None, None))
        at += fact[3]
    out.append((None,) * 6 + (number, None, pairs, times))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), CHUNKED)], schema=CHUNKED)


def aligned(docs: DataFrame, left: str, right: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Every text's alignment and links, with a row for each chunk that lists its id pairs and how often they are linked."""
    text_batches(docs.sparkSession, 256)

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        """Texts to walk as one, by their length."""
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size > LOT_CHARACTERS or len(ids) == 1000:
                    yield ids, texts
                    ids, texts, size = [], [], 0
        if ids:
            yield ids, texts

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = worker_tokenizers(left, right)
        number, held = TaskContext.get().partitionId() << 32, 0
        ids, facts, link_a, link_b = [], [], [], []
        for some, texts in lots(batches):
            fact, a, b, _ = aligned_texts(texts, sides)
            ids, facts, held = ids + some, facts + fact, held + len(a)
            link_a.append(a)
            link_b.append(b)
            if held >= chunk_links or len(ids) >= 10_000:
                yield _chunk(ids, facts, link_a, link_b, number)
                number, held = number + 1, 0
                ids, facts, link_a, link_b = [], [], [], []
        if ids:
            yield _chunk(ids, facts, link_a, link_b, number)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, f"{ROW}, chunk long, links binary, pairs array<long>, times array<long>")


def pair_counts(listed: DataFrame) -> DataFrame:
    """``pair, count, best`` over all chunks: how often two ids are linked, and whether no left id is with the right one more often.

    ``listed`` has ``pair`` and ``n``, a row for each chunk that has the pair.
    """
    counts = listed.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)))
    most = counts.groupBy(F.col("b").alias("_b")).agg(F.max("count").alias("_most"))
    return counts.join(most, F.col("b") == F.col("_b")).select("pair", "count", (F.col("count") == F.col("_most")).alias("best"))


def with_counts(table: DataFrame) -> DataFrame:
    """The texts of ``aligned`` (read four times, the same rows each time) with ``n_best`` and ``count_sum``."""
    listed = table.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x")).select(
        "chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    back = listed.select("chunk", "place", "pair").join(pair_counts(listed), "pair").select(
        F.col("chunk").alias("of"), "place", "count", "best")
    texts = table.where("pairs IS NULL").select(*ALIGNED.names, "chunk", "links")
    schema = pa.schema([*ALIGNED, ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def sums(texts: pa.Table, counted: pa.Table) -> pa.Table:
        count, best = np.zeros(counted.num_rows, dtype=np.int64), np.zeros(counted.num_rows, dtype=bool)
        place = counted.column("place").to_numpy()
        count[place], best[place] = counted.column("count").to_numpy(), counted.column("best").to_numpy(zero_copy_only=False)
        kind, n_best, total = _index_type(len(count)), [], []
        for links in texts.column("links"):
            at = np.frombuffer(links.as_py(), dtype=kind)
            n_best.append(int(best[at].sum()))
            total.append(int(count[at].sum()))
        kept = [texts.column(c).combine_chunks() for c in ALIGNED.names]
        return pa.Table.from_arrays([*kept, pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], schema=schema)

    return texts.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(sums, f"{ROW}, n_best long, count_sum long")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and corpus-wide pair counts of all ``documents``."""
    out = with_counts(store(aligned(documents(spark, sf_dir), *default_tokenizers()), "alignment"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
