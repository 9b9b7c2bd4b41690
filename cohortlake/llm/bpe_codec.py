"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus is cut to words once to count them; the ``lexicon_size`` most frequent words are merged on the
driver and compiled into a minimal acyclic automaton whose arcs carry numbers. The numbers along a word's
path add up to its place in the table of id sequences, so words share their suffixes whatever their ids
are. The automaton is broadcast (its size is bounded by ``lexicon_size``), written to a file without a name
in each Python worker, and memory-mapped. Words outside it are merged exactly, by rank. Workers remember the
words they met last.

The vocabulary file's normalizer (composition, white space, lower case), pre-tokenizer, word-end suffix and
special tokens are followed; it has no decoder, so that decoding joins the tokens by single spaces.

Defined cases: a null text counts as empty (no ids, empty string); special tokens inside a text are
encoded as such; null ids and repeated rows each give a row; an empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import Memo, released, text_of, written

# The pre-tokenizer's pattern.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
_word = regex.compile(WORD, regex.V0)
REMEMBERED = 100_000  # words of 64 letters at most that a worker remembers, twice at most
SIDE_BY_SIDE = 4096  # words that are merged together
LONG = 100  # bytes of a word from which a heap merges faster than a list


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible in Latin-1, else the next one from U+0100."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class Vocabulary:
    """What a vocabulary file says; picklable, and of the file's size."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.ids: dict[str, int] = said["model"]["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(said["model"]["merges"])}
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token
        self.letters = byte_letters()
        # The same as arrays: the token of each byte inside a word and at its end, and the pairs in the order of their numbers.
        self.inner, self.end = (np.array([self.ids.get(letter + sign, -1) for letter in self.letters], np.int64) for sign in ("", WORD_END))
        pairs = [(self.ids[a] << 32 | self.ids[b], rank, self.ids[a + b]) for (a, b), rank in self.ranks.items() if a in self.ids and b in self.ids and a + b in self.ids]
        self.pairs, self.pair_ranks, self.pair_tokens = (np.array(column, np.int64) for column in zip(*sorted(pairs), strict=True)) if pairs else (np.empty(0, np.int64),) * 3
        self.whole = len(pairs) == len(self.ranks) and (self.inner >= 0).all() and (self.end >= 0).all()

    def merge(self, word: str) -> list[int]:
        """The ids of one word, by merging the pair of the lowest rank, of equal ranks the first, until none is left."""
        parts = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        parts[-1] += WORD_END
        merged = self._merge_long(parts) if len(parts) > LONG else self._merge_short(parts)
        return [self.ids[p] for p in merged if p in self.ids]

    def merge_many(self, words: list[str]) -> list[bytes]:
        """The ids of many words as little-endian unsigned 32-bit integers: words of about one length are merged side by side, a pair of each at a time."""
        out: list[bytes] = [b""] * len(words)
        block = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(b) for b in block])
        for i in np.flatnonzero(sizes > LONG).tolist() if self.whole else range(len(words)):
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        order = np.argsort(sizes, kind="stable")[: int((sizes <= LONG).sum())] if self.whole else []
        for begin in range(0, len(order), SIDE_BY_SIDE):
            some = order[begin : begin + SIDE_BY_SIDE]
            tokens, counts = self._merge_equal([block[i] for i in some], sizes[some])
            stops = np.cumsum(counts).tolist()
            ids = tokens.astype("<u4").tobytes()
            for i, low, high in zip(some.tolist(), [0, *stops], stops, strict=False):
                out[i] = ids[4 * low : 4 * high]
        return out

    def _ranked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each pair in ``pairs``, or their number where there is none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (b >= 0), at, len(self.pairs))

    def _merge_equal(self, block: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words one after the other, and how many each has."""
        n, width = len(block), int(sizes[-1])
        inside = np.arange(width) < sizes[:, None]
        token = np.full((n, width + 1), -1, np.int64)  # one more, so that each has a next
        data = np.frombuffer(b"".join(block), np.uint8)
        token[:, :-1][inside] = self.inner[data]
        last = np.cumsum(sizes) - 1
        token[np.arange(n), sizes - 1] = self.end[data[last]]
        rank_of = np.r_[self.pair_ranks, 1 << 40]
        pair = self._ranked(token[:, :-1], token[:, 1:])
        rank = rank_of[pair]
        open_, column = np.arange(n), np.arange(width + 1)
        while len(open_):
            at = rank[open_].argmin(axis=1)  # of equal ranks the first
            more = rank[open_, at] < 1 << 40
            open_, at = open_[more], at[more]
            if not len(open_):
                break
            made = self.pair_tokens[pair[open_, at]]
            # What stands behind the pair moves up by one.
            shift = np.minimum(column + (column > at[:, None]), width)
            token[open_] = np.take_along_axis(token[open_], shift, axis=1)
            token[open_, at] = made
            token[open_, width] = -1
            pair[open_] = np.take_along_axis(pair[open_], np.minimum(shift[:, :-1], width - 1), axis=1)
            pair[open_, width - 1] = len(self.pairs)
            pair[open_, at] = self._ranked(made, token[open_, at + 1])
            before = at > 0
            rows, place = open_[before], at[before] - 1
            pair[rows, place] = self._ranked(token[rows, place], made[before])
            rank[open_] = rank_of[pair[open_]]
        kept = token >= 0
        return token[kept], kept.sum(axis=1)

    def _merge_short(self, parts: list[str]) -> list[str]:
        rank, none = self.ranks.get, 1 << 30
        order = [rank(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while order and (best := min(order)) < none:
            i = order.index(best)
            parts[i] += parts.pop(i + 1)
            del order[i]
            if i:
                order[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(order):
                order[i] = rank((parts[i], parts[i + 1]), none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """By a heap of pairs and links to the neighbours: n log n steps, where the list takes n squared."""
        ranks, end = self.ranks, len(parts)
        after, before = [*range(1, end + 1)], [*range(-1, end - 1)]
        heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(parts, parts[1:], strict=False)) if pair in ranks]
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i] if parts[i] == left else end
            if j == end or parts[j] != right:
                continue  # one of the two has been merged since
            parts[i], parts[j] = left + right, ""
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (pair := (parts[i], parts[k])) in ranks:
                    heappush(heap, (ranks[pair], i, *pair))
            h = before[i]
            if h >= 0 and (pair := (parts[h], parts[i])) in ranks:
                heappush(heap, (ranks[pair], h, *pair))
        return [p for p in parts if p]


def normal(text: str) -> str:
    """Composed, lower case letter by letter. White space needs no folding: it only separates words."""
    text = unicodedata.normalize("NFC", text)
    return (text.replace("Σ", "σ") if "Σ" in text else text).lower()


def words(text: str) -> list[str]:
    return _word.findall(normal(text))


def compiled(lexicon: dict[bytes, list[int]]) -> bytes:
    """The automaton and its id sequences as one block of bytes.

    Words are added in order; a state that no further word can change is replaced by an equal one if there
    is one. A state is (final, ((byte, target), ...)); each arc then gets the count of the words before it.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []

    def settle(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # of the last word: (final, arcs that are settled)
    last = b""
    order = sorted(lexicon)

    def fold(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, arcs)))

    for word in order:
        same = next((i for i, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
        fold(same)
        path += [[False, []] for _ in word[same:]]
        path[-1][0], last = True, word
    fold(0)
    root = settle(*path[0])
    below = [0] * len(states)
    for s, (final, arcs) in enumerate(states):  # targets come before what points to them
        below[s] = final + sum(below[t] for _, t in arcs)
    first, label, target, before = [0], [], [], []
    for final, arcs in states:
        seen = int(final)
        for byte, t in arcs:
            label.append(byte)
            target.append(t)
            before.append(seen)
            seen += below[t]
        first.append(len(label))
    ids = [lexicon[w] for w in order]
    blocks = [np.array([root]), np.array(first), np.array([f for f, _ in states]), np.array(label), np.array(target), np.array(before), np.cumsum([0, *map(len, ids)]), np.array([i for x in ids for i in x])]
    blocks = [b.astype("<u4") for b in blocks]
    return np.array([len(b) for b in blocks], "<u4").tobytes() + b"".join(b.tobytes() for b in blocks)


class Lexicon:
    """A compiled automaton, mapped from a file that no name points to any more."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes, at, parts = np.frombuffer(self.map, "<u4", 8), 32, []
        for size in sizes.tolist():
            parts.append(np.frombuffer(self.map, "<u4", size, at))
            at += 4 * size
        root, first, final, label, target, before, self.begin, self.ids = parts
        self.root = int(root[0])
        # Arcs in the order of their states and bytes, so that many words can take a step at once.
        self.arcs = np.repeat(np.arange(len(final), dtype=np.int64), np.diff(first)) << 8 | label
        self.steps = target, before, final
        # Views of the map that index to plain integers.
        self.first, self.final, self.label, self.target, self.before = (memoryview(p) for p in (first, final, label, target, before))

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as little-endian unsigned 32-bit integers; None if the lexicon lacks it."""
        state, place = self.root, 0
        first, label = self.first, self.label
        for byte in word:
            low, high = first[state], first[state + 1]
            while low < high:  # arcs are in the order of their bytes
                middle = (low + high) // 2
                if label[middle] < byte:
                    low = middle + 1
                else:
                    high = middle
            if low == first[state + 1] or label[low] != byte:
                return None
            place += self.before[low]
            state = self.target[low]
        return self.ids[self.begin[place] : self.begin[place + 1]].tobytes() if self.final[state] else None


    def get_many(self, words: list[bytes]) -> list[bytes | None]:
        """What ``get`` gives for each word: all words take a step along their arcs at a time."""
        out: list[bytes | None] = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data, begin = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        state, place = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        target, before, final = self.steps
        on, step = np.flatnonzero(sizes > 0) if len(self.arcs) else np.empty(0, np.int64), 0
        while len(on):
            key = state[on] << 8 | data[begin[on] + step]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            there = self.arcs[at] == key
            on, at, step = on[there], at[there], step + 1
            place[on] += before[at]
            state[on] = target[at]
            ends = sizes[on] == step
            for i in on[ends][final[state[on[ends]]] > 0].tolist():
                out[i] = self.ids[self.begin[place[i]] : self.begin[place[i] + 1]].tobytes()
            on = on[~ends]
        return out


class Codec:
    """Encodes and decodes whole texts in a worker."""

    def __init__(self, vocabulary: Vocabulary, block: bytes):
        self.vocabulary, self.lexicon = vocabulary, Lexicon(block)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.tokens = [t.encode() for t in vocabulary.tokens]
        self.met = Memo(self._ids, REMEMBERED)

    def _ids(self, word: str) -> bytes:
        found = self.lexicon.get(word.encode("utf-8", "surrogatepass"))
        return np.array(self.vocabulary.merge(word), "<u4").tobytes() if found is None else found

    def meet(self, met: set[str]) -> dict[str, bytes]:
        """The ids of all these words: remembered, from the lexicon, or merged side by side."""
        known, new = {}, []
        for word in met:
            found = self.met.get(word) or self.met.before.get(word)
            if found is None:
                new.append(word)
            else:
                known[word] = found
        listed = dict(zip(new, self.lexicon.get_many([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))
        merged = [w for w, ids in listed.items() if ids is None]
        known.update(listed)
        known.update(zip(merged, self.vocabulary.merge_many(merged), strict=True))
        for word, ids in known.items():
            if len(word) <= self.met.longest and word not in self.met:
                self.met.keep(word, ids)
        return known

    def encode_many(self, texts: list[str], most: int = 1 << 20) -> Iterator[bytes]:
        """The ids of each text; the words of about ``most`` letters of texts are looked up together."""
        begin = 0
        while begin < len(texts):
            stop, held = begin, 0
            while stop < len(texts) and (stop == begin or held + len(texts[stop]) <= most):
                held, stop = held + len(texts[stop]), stop + 1
            cut = [self.special.split(t) if self.special is not None and "<|" in t else [t] for t in texts[begin:stop]]
            said = [[words(p) if k % 2 == 0 else [p] for k, p in enumerate(pieces)] for pieces in cut]
            known = self.meet({w for parts in said for part in parts[::2] for w in part})
            for parts in said:
                yield b"".join(b"".join(map(known.__getitem__, part)) if k % 2 == 0 else np.array([self.vocabulary.special[part[0]]], "<u4").tobytes() for k, part in enumerate(parts))
            begin = stop

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))

    def decode(self, ids: bytes) -> bytes:
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _count_batches(special: list[str], most: int = 200_000):
    cut = regex.compile("|".join(map(regex.escape, special))) if special else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.encode("utf-8", "surrogatepass") for w in seen], pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])

        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                for piece in cut.split(text) if cut and "<|" in text else (text,):
                    seen.update(words(piece))
                if len(seen) > most:
                    yield flushed()
                    seen.clear()
            released()
        yield flushed()

    return run


def word_counts(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """word (UTF-8), n over all texts."""
    counted = docs.select(text_of(text_col).alias("text")).mapInArrow(_count_batches(list(vocabulary.special)), "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, lexicon_size: int, text_col: str = "text") -> bytes:
    """Of the words that occur twice or more the most frequent, ``lexicon_size`` at most; words of about the same count go in or stay out together."""
    counts = written(word_counts(docs, vocabulary, text_col).where("n > 1").withColumn("step", F.floor(F.log2("n") * 16)), "word-counts")
    least, total = None, 0
    for r in counts.groupBy("step").agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():  # about a thousand steps at most
        total += r["n"]
        if total > lexicon_size:
            break
        least = r["step"]
    frequent = [] if least is None else counts.where(F.col("step") >= least).select("word").collect()
    block = compiled({bytes(r["word"]): vocabulary.merge(bytes(r["word"]).decode("utf-8", "surrogatepass")) for r in frequent})
    del frequent
    released()  # the driver's memory too
    return block


_codecs: dict[int, Codec] = {}


def _codec(shared: Broadcast) -> Codec:
    if shared.value[0] not in _codecs:
        _codecs.clear()
        _codecs[shared.value[0]] = Codec(*shared.value[1:])
    return _codecs[shared.value[0]]


def _encode_batches(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            texts = batch.column("text")
            # A batch of very long texts goes on in parts, so that few ids are held at a time.
            for i in range(0, len(texts), 256):
                ids = list(codec.encode_many(texts[i : i + 256].to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i : i + 256], pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def _digest_batches(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            rows = []
            texts = (batch.column("text").slice(i, 256).to_pylist() for i in range(0, batch.num_rows, 256))
            for ids in chain.from_iterable(map(codec.encode_many, texts)):
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            count, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            released()

    return run


def _decode_batches(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            decoded = [codec.decode(i.as_py() or b"").decode() for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.string())], ["doc_id", "decoded"])

    return run


def prepare(docs: DataFrame, path: str | None = None, lexicon_size: int = 65_536, text_col: str = "text") -> Broadcast:
    """The vocabulary and the lexicon of the frequent words of ``docs``, broadcast once for encode and decode."""
    vocabulary = Vocabulary(path or public_tokenizers.path("word_bpe_49k.json"))
    block = build_lexicon(docs, vocabulary, lexicon_size, text_col)
    return docs.sparkSession.sparkContext.broadcast((hashlib.sha256(block).hexdigest(), vocabulary, block))


def encode(docs: DataFrame, shared: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(_encode_batches(shared), "doc_id long, ids binary")


def decode(encoded: DataFrame, shared: Broadcast) -> DataFrame:
    """doc_id, decoded."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode_batches(shared), "doc_id long, decoded string")


def round_trip(docs: DataFrame, path: str | None = None, lexicon_size: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, only the digests leave the worker."""
    shared = prepare(docs, path, lexicon_size, text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(_digest_batches(shared), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
