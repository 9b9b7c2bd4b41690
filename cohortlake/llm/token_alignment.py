"""Cross-tokenizer alignment by exact-text deduplication.

Documents shuffle by their full text, so that each distinct text is tokenised and aligned once; the counts of
linked id pairs weigh a text by its copies, and what is measured of a text is joined back to the ids of its
documents by the text's SHA-256.

Within a text the work is done once for each distinct unit. A unit ends before a space between two characters
that are neither white space nor U+2581. Both tokenizers cut there whatever stands around it (the byte-level
one takes a space into the word behind it; no entry of the piece vocabulary has U+2581 behind another
character), so a unit gives the ids it gives inside the text, and the tokens of both end with it. Workers
remember the units they met last. The offsets where tokens end are marks over the bytes of many units at once: groups
end at marks of both, and each stretch between marks of either lies in one token of each, which is a link.

A batch of texts of about ``BATCH_CHARS`` letters is one written row: its texts' measures, its distinct pairs with their
weighted counts, and which pairs each text holds. Only a batch's distinct pairs shuffle, to be counted over
the corpus and to carry the counts back to the batch. No vocabulary, pair table or text passes the driver but
the two vocabulary files.

Defined cases: a null or empty text, or one whose tokens don't give back a space and the text, has no tokens: its
measures are zero and ``groups_sha256`` is empty; null ids and repeated rows each give a row; strings of special
tokens in a text are plain text; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.bpe_codec import byte_letters
from cohortlake.llm.common import Memo, released, text_of, written

BATCH_CHARS = 8_000_000  # of the texts in one row; a longer text is a row of its own
PART_CHARS = 1_000_000  # aligned at a time; a longer text is cut between units
REMEMBERED = 60_000  # units of 64 letters at most that a worker remembers, twice at most
PIECE_SPACE = "▁"
_between = re.compile(rf"(?<=[^\s{PIECE_SPACE}]) (?=[^\s{PIECE_SPACE}])")


def parts_of(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """A text in parts of about ``most`` letters, cut between units."""
    begin = 0
    while len(text) - begin > most:
        cut = _between.search(text, begin + most)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:] if begin else text


class Numbers(dict):
    """Numbers what it is asked for in the order of the first time, and notes what may not stand alone between spaces."""

    def __init__(self):
        super().__init__()
        self.rough = bytearray()

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.rough.append(not unit or unit[0].isspace() or unit[-1].isspace() or PIECE_SPACE in unit)
        return number

    def of(self, part: str) -> np.ndarray:
        found = np.array(list(map(self.__getitem__, part.split(" "))), np.int32)
        if np.frombuffer(self.rough, np.uint8)[found].any():
            found = np.array(list(map(self.__getitem__, _between.split(part))), np.int32)
        return found


class Aligner:
    """Both tokenizers in a worker."""

    def __init__(self, entries: str, pieces: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(entries), SentencePieceProcessor(model_proto=pieces)
        self.a.encode_special_tokens = True
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        a_size, b_size = self.a.get_vocab_size(), self.b.get_piece_size()
        entry = (self.a.id_to_token(i) or "" for i in range(a_size))
        self.a_bytes = [bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e in entry]
        piece = ((i, self.b.id_to_piece(i)) for i in range(b_size))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(PIECE_SPACE, " ").encode() for i, p in piece]
        self.a_length, self.b_length = ([len(x) for x in table] for table in (self.a_bytes, self.b_bytes))
        # An id with the sign behind it: within its group, and last of its group.
        self.said = np.array([f"{i}{sign}" for size, signs in ((a_size, ",|"), (b_size, ",;")) for sign in signs for i in range(size)], object)
        self.starts = np.cumsum([0, a_size, a_size, b_size])
        self.met = Memo(lambda unit: self.align([unit])[0], REMEMBERED)

    def of(self, units: list[str]) -> list[tuple | None]:
        """What ``align`` gives for each unit, remembered."""
        known = [self.met.get(u) or self.met.before.get(u) for u in units]
        new = [i for i, k in enumerate(known) if k is None]
        for begin in range(0, len(new), 4096):
            some = new[begin : begin + 4096]
            for i, found in zip(some, self.align([units[i] for i in some]), strict=True):
                known[i] = found
                if found is not None and len(units[i]) <= self.met.longest:
                    self.met.keep(units[i], found)
        return known

    def align(self, units: list[str]) -> list[tuple | None]:
        """n_a, n_b, n_groups, the groups' string and the links (b << 32 | a, in order) of each unit; None where the tokens give other bytes."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        b = self.b.encode(units, num_threads=1)
        whole = [f" {u}".encode("utf-8", "surrogatepass") for u in units]
        fine = [i for i, w in enumerate(whole) if sum(map(self.a_length.__getitem__, a[i])) == len(w) == sum(map(self.b_length.__getitem__, b[i]))]
        # Of equal length unit by unit, so that all are given back if all together are.
        if any(b"".join(map(table.__getitem__, chain.from_iterable(ids[i] for i in fine))) != b"".join(whole[i] for i in fine) for table, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            fine = [i for i in fine if b"".join(map(self.a_bytes.__getitem__, a[i])) == whole[i] == b"".join(map(self.b_bytes.__getitem__, b[i]))]
        out: list[tuple | None] = [None] * len(units)
        if not fine:
            return out
        a_ids, b_ids = (np.fromiter(chain.from_iterable(ids[i] for i in fine), np.int64) for ids in (a, b))
        a_ends, b_ends = np.cumsum(np.array(self.a_length)[a_ids]), np.cumsum(np.array(self.b_length)[b_ids])
        size = int(a_ends[-1])
        a_mark, b_mark = np.zeros(size, bool), np.zeros(size, bool)
        a_mark[a_ends - 1], b_mark[b_ends - 1] = True, True
        both, either = a_mark & b_mark, np.flatnonzero(a_mark | b_mark)
        group = np.cumsum(both, dtype=np.int64) - both  # of each byte
        a_group, b_group = group[a_ends - 1], group[b_ends - 1]
        # A link for each stretch: the tokens that it lies in.
        link = b_ids[(np.cumsum(b_mark) - b_mark)[either]] << 32 | a_ids[(np.cumsum(a_mark) - a_mark)[either]]
        # Ids in the order in which they are said: of each group those of A, then those of B.
        said = np.empty(len(a_ids) + len(b_ids), np.int64)
        said[np.arange(len(a_ids)) + np.searchsorted(b_group, a_group)] = a_ids + self.starts[both[a_ends - 1].astype(int)]
        said[np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")] = b_ids + self.starts[2 + both[b_ends - 1]]
        words = self.said[said].tolist()
        stops = np.cumsum([len(whole[i]) for i in fine])
        a_at, b_at, link_at = (np.r_[0, at].tolist() for at in (np.searchsorted(a_ends, stops, "right"), np.searchsorted(b_ends, stops, "right"), np.searchsorted(either, stops)))
        group_at, links = np.r_[0, np.cumsum(both)[stops - 1]].tolist(), link.tobytes()
        for k, i in enumerate(fine):
            text = "".join(words[a_at[k] + b_at[k] : a_at[k + 1] + b_at[k + 1]])[:-1]
            out[i] = (a_at[k + 1] - a_at[k], b_at[k + 1] - b_at[k], group_at[k + 1] - group_at[k], text, links[8 * link_at[k] : 8 * link_at[k + 1]])
        return out


BATCH = "batch long, digests binary, sizes binary, n_units int, shas array<string>, measures binary, units binary, links binary, link_sizes binary, pairs array<long>, counts array<long>"


def packed(array: np.ndarray) -> bytes:
    return pa.compress(array.tobytes(), codec="zstd", asbytes=True) if len(array) else b""


def unpacked(block: bytes, size: int, kind: str) -> np.ndarray:
    """``size`` values of a packed array."""
    return np.frombuffer(pa.decompress(block, size * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if size else np.empty(0, kind)


class Batch:
    """Texts on their way into one row."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.numbers = aligner, Numbers()
        self.found: list[tuple | None] = []  # of each unit
        self.digests, self.copies, self.shas, self.open = [], [], [], []
        self.units: list[list[np.ndarray]] = []  # of each text
        self.chars = self.waiting = 0

    def add(self, digest: bytes, copies: int, text: str) -> None:
        self.digests.append(digest)
        self.copies.append(copies)
        self.units.append([])
        self.shas.append(hashlib.sha256())
        for part in parts_of(text) if text else ():
            units = self.numbers.of(part)
            self.open.append((len(self.units) - 1, len(self.units[-1]), units))
            self.units[-1].append(units)
            self.chars, self.waiting = self.chars + len(part), self.waiting + len(part)
            if self.waiting >= PART_CHARS:
                self.settle()

    def settle(self) -> None:
        """Align the units met since, and hash what waits for them."""
        if len(self.found) < len(self.numbers):
            self.found += self.aligner.of(list(self.numbers)[len(self.found) :])
        said = [None if f is None else f[3] for f in self.found]
        for text, before, units in self.open:
            if self.shas[text] is None:
                continue
            some = list(map(said.__getitem__, units.tolist()))
            if None in some:
                self.shas[text] = None  # a unit that isn't given back: the text has no tokens
            else:
                self.shas[text].update((";" * (before > 0) + ";".join(some)).encode())
        self.open, self.waiting = [], 0

    def row(self) -> pa.RecordBatch:
        self.settle()
        units = [np.concatenate(u) if u and s is not None else np.empty(0, np.int32) for u, s in zip(self.units, self.shas, strict=True)]
        sizes = np.array([len(u) for u in units], np.int64)
        units = np.concatenate([*units, np.empty(0, np.int32)])
        weights = np.bincount(units, np.repeat(np.array(self.copies, float), sizes), len(self.found)).astype(np.int64)
        used = [f if f is not None and w else (0, 0, 0, "", b"") for f, w in zip(self.found, weights.tolist(), strict=True)]
        links = np.frombuffer(b"".join(f[4] for f in used), np.int64)
        link_sizes = np.array([len(f[4]) // 8 for f in used], np.int32)
        pairs, where = np.unique(links, return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, where, np.repeat(weights, link_sizes))
        of_unit = np.array([(f[0], f[1], f[2]) for f in used], np.int64).reshape(-1, 3)
        measures = sums(np.column_stack([of_unit, link_sizes.astype(np.int64)]), units, sizes)
        shas = ["" if s is None or not n else s.hexdigest() for s, n in zip(self.shas, sizes.tolist(), strict=True)]
        values = {
            "batch": uuid.uuid4().int >> 65, "digests": b"".join(self.digests), "sizes": packed(sizes), "n_units": len(used), "shas": shas, "measures": packed(measures),
            "units": packed(units), "links": packed(where.astype(np.int32)), "link_sizes": packed(link_sizes), "pairs": pairs, "counts": counts,
        }
        kinds = {"batch": pa.int64(), "n_units": pa.int32(), "shas": pa.list_(pa.string()), "pairs": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in values.items()], list(values))


def sums(of_unit: np.ndarray, units: np.ndarray, sizes: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """For each text the sums of its units' columns, some units at a time."""
    out = np.zeros((len(sizes), of_unit.shape[1]), np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    for begin in range(0, len(units), step):
        some, of = of_unit[units[begin : begin + step]], text[begin : begin + step]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        out[of[first]] += np.add.reduceat(some, first, axis=0)
    return out


_aligners: dict[str, Aligner] = {}


def _align_batches(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, *files = shared.value
        if name not in _aligners:
            _aligners.clear()
            _aligners[name] = Aligner(*files)
        batch = Batch(_aligners[name])
        for arrow in batches:
            for digest, copies, text in zip(*(arrow.column(c) for c in ("digest", "copies", "text")), strict=True):
                batch.add(digest.as_py(), copies.as_py(), text.as_py())
                if batch.chars >= BATCH_CHARS:
                    yield batch.row()
                    batch = Batch(_aligners[name])
                    released()
        if batch.digests:
            yield batch.row()

    return run


def aligned_batches(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, text_col: str = "text") -> DataFrame:
    """The distinct texts, aligned: one written row for each batch of them."""
    entries = Path(a_path or public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    pieces = Path(b_path or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    shared = docs.sparkSession.sparkContext.broadcast((hashlib.sha256(entries.encode() + pieces).hexdigest(), entries, pieces))
    texts = docs.select(text_of(text_col).alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text")
    return written(texts.mapInArrow(_align_batches(shared), BATCH), "aligned-texts")


def pair_counts(batches: DataFrame) -> DataFrame:
    """pair (b << 32 | a), n (links of the corpus that hold it), best (no other pair of b has more): bounded by the two vocabularies."""
    counts = written(batches.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")), "pair-counts")
    most = counts.groupBy(F.shiftright("pair", 32).alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, F.shiftright("pair", 32) == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


MEASURES = "digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _measured(left: pa.Table, right: pa.Table) -> pa.Table:
    """The measures of the texts of one batch from its row and the counts of its pairs."""
    row = {c: left.column(c)[0].as_py() for c in left.column_names}
    texts = len(row["shas"])
    sizes, measures = unpacked(row["sizes"], texts, "<i8"), unpacked(row["measures"], 4 * texts, "<i8").reshape(-1, 4)
    link_sizes = unpacked(row["link_sizes"], row["n_units"], "<i4")
    links = unpacked(row["links"], int(link_sizes.sum()), "<i4")
    place = right.column("place").to_numpy()
    of_pair = np.zeros((len(place), 2), np.int64)
    of_pair[place] = np.column_stack([right.column("best").to_numpy(zero_copy_only=False), right.column("n").to_numpy()])
    of_unit = sums(of_pair, links, link_sizes)
    more = sums(of_unit, unpacked(row["units"], int(sizes.sum()), "<i4"), sizes)
    digests = [row["digests"][i : i + 32] for i in range(0, 32 * texts, 32)]
    columns = [pa.array(digests, pa.binary()), *(pa.array(c) for c in measures.T.copy()), *(pa.array(c) for c in more.T.copy()), pa.array(row["shas"], pa.string())]
    return pa.table(columns, names=[c.split()[0] for c in MEASURES.split(", ")])


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    batches = aligned_batches(docs, a_path, b_path, text_col)
    asked = batches.select(F.col("batch").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(batches), "pair").select("of", "place", "n", "best")
    rows = batches.drop("counts", "pairs")
    measured = rows.groupBy("batch").cogroup(answers.groupBy("of")).applyInArrow(_measured, MEASURES)
    measured = written(measured, "text-measures")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text_of(text_col), 256)).alias("digest"))
    return ids.join(measured, "digest").select("doc_id", *[c.split()[0] for c in MEASURES.split(", ")[1:]])
