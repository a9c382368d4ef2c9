"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A text becomes characters, white space marked, and an agenda of candidate merges ordered
by piece score and place. A candidate taken from the agenda is skipped where a keyed hash
of (seed, document, number of the word in it, the places) falls below the dropout rate, so
every candidate of every occurrence has a coin of its own, and the segmentation is the
same on every run and machine. Without dropout the pieces are those of the library.

No piece holds a space mark after another character (checked when the model is read), so
merges never cross the start of a word: every word of a chunk of texts has an agenda of its
own, and all agendas run in lockstep. A step takes the first candidate of each of them, throws
its coin and merges the pair or strikes the candidate, for all words at once in arrays.
Nothing drawn is remembered. Words beyond ``SHORT`` characters run alone, with a heap.

Characters without a piece, and a literal space mark in the text, are spelled as bytes,
so decoding gives back every text exactly. NULL and empty texts have no pieces; repeated
rows get equal pieces; a text of any length is encoded whole. Documents without id are told
apart by their text. The model has a fixed size and is broadcast by content.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import schema_with, session

MARK = "▁"
DROPOUT = 0.1
SEED = 17
# characters encoded at a time, in whole texts
CHUNK = 1_000_000
# words up to this length run in lockstep
SHORT = 40
# a character without a piece is a symbol of its own, above all piece ids
BASE = 1 << 16
SYMBOL_BITS = 21
# an agenda entry is a rank and a place
PLACE_BITS = 6
DONE = np.iinfo(np.int32).max
NEVER = float("inf")
# stands for a mark that the text itself holds; spelled as bytes
LITERAL = "▁literal"
# a word: its space marks, then what follows up to the next mark
WORD = regex.compile(r" *[^ ]+| +")


class Vocabulary:
    """Pieces, scores and byte pieces of a BPE model with byte fallback."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [
            i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
        ]
        self.ids = {self.pieces[i]: i for i in plain}
        # least first
        self.ranks = {self.pieces[i]: -sp.get_score(i) for i in plain}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        self.spelled = [
            bytes([self.bytes[i]]) if i in self.bytes else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("the model has pieces across words")
        if n > BASE:
            raise ValueError("the model has too many pieces")
        self.symbols = np.arange(0x110000, dtype=np.int32) + BASE
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        self.symbols[ord(" ")] = self.symbols[ord(MARK)]
        self.pairs = Pairs(self)

    def decode(self, ids: Sequence[int]) -> str:
        """The text that was encoded: byte pieces as bytes, marks as spaces."""
        numbers = np.asarray(ids, np.int64).tolist()
        # the mark that encoding puts before a text goes
        return b"".join(map(self.spelled.__getitem__, numbers)).decode("utf-8")[1:]


class Pairs:
    """Which two symbols make a piece: a hash table over all splits of all pieces."""

    def __init__(self, vocabulary: Vocabulary):
        order = {r: k for k, r in enumerate(sorted(set(vocabulary.ranks.values())))}
        found = {}
        for piece, i in vocabulary.ids.items():
            for at in range(1, len(piece)):
                halves = [
                    int(vocabulary.symbols[ord(h)]) if len(h) == 1 else vocabulary.ids.get(h)
                    for h in (piece[:at], piece[at:])
                ]
                if None not in halves:
                    found[halves[0] << SYMBOL_BITS | halves[1]] = (order[vocabulary.ranks[piece]], i)
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.zeros(1 << bits, np.int32)
        self.made = np.zeros(1 << bits, np.int32)
        keys = np.fromiter(found, np.int64, len(found))
        for key, at in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], (self.ranks[at], self.made[at]) = key, found[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(STEP)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The table's place of each pair, -1 for pairs that are no piece."""
        keys = left.astype(np.int64) << SYMBOL_BITS | right
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, at, -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            same = held == keys[open_]
            out[open_[same]] = at[open_[same]]
            open_ = open_[~same & (held >= 0)]
        return out

    def entries(self, left: np.ndarray, right: np.ndarray, place) -> np.ndarray:
        """Agenda entries of pairs whose left symbol stands at ``place``."""
        at = self.find(left, right)
        return np.where(at < 0, DONE, self.ranks[at] << PLACE_BITS | place).astype(np.int32)


def coin_key(seed: int, document: int) -> int:
    return xxhash.xxh64_intdigest(f"{seed}:{document}:".encode())


def _place(role: int, at: int) -> int:
    return xxhash.xxh64_intdigest(f"{role}:{at}")


# random numbers of the places of a short word, by role: tabulation hashing
LEFT, RIGHT, END = ([_place(k, at) for at in range(SHORT + 1)] for k in range(3))
# the multipliers of splitmix64
STEP, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
LOW_64 = (1 << 64) - 1


def coin(mixed: int) -> int:
    """32 bits of a key combined with the places of a candidate."""
    mixed = (mixed ^ (mixed >> 30)) * MIX_1 & LOW_64
    return ((mixed ^ (mixed >> 27)) * MIX_2 & LOW_64) >> 32


def coins(mixed: np.ndarray) -> np.ndarray:
    """The same for an array of unsigned 64-bit numbers."""
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(MIX_1)
    return ((mixed ^ (mixed >> np.uint64(27))) * np.uint64(MIX_2)) >> np.uint64(32)


def word_keys(key: int, n: int) -> np.ndarray:
    """Keys of the first ``n`` words of a document."""
    mixed = np.uint64(key) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(STEP)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(MIX_1)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(MIX_2)
    return mixed ^ (mixed >> np.uint64(31))


def skipped(key: int, limit: int, left: int, right: int, end: int) -> bool:
    """The keyed coin of a candidate merge of the spans [left, right) and [right, end)."""
    return coin(key ^ _place(0, left) ^ _place(1, right) ^ _place(2, end)) < limit


def encode_word(word: str, vocabulary: Vocabulary, key: int = 0, limit: int = 0) -> tuple[int, ...]:
    """Piece ids of a word with its space marks.

    A candidate merge is skipped with probability ``limit / 2^32``, by ``key``. ``word``
    holds plain spaces for marks, so a literal mark is an ordinary character.
    """
    if MARK in word or len(word) > SHORT:
        parts = _merge_long(word, vocabulary, key, limit)
    else:
        parts = _merge_short(word, vocabulary, key, limit)
    return _ids(parts, vocabulary)


def _ids(parts: list[str], vocabulary: Vocabulary) -> tuple[int, ...]:
    out: list[int] = []
    for part in parts:
        found = vocabulary.ids.get(part)
        if part is LITERAL:
            out.extend(vocabulary.byte_ids[b] for b in MARK.encode())
        elif found is None:
            out.extend(vocabulary.byte_ids[b] for b in part.encode("utf-8"))
        else:
            out.append(found)
    return tuple(out)


def _merge_short(word: str, vocabulary: Vocabulary, key: int, limit: int) -> list[str]:
    """The agenda as a list with one place for every pair of neighbours."""
    rank, never, n = vocabulary.ranks.get, NEVER, len(word)
    parts = list(word.replace(" ", MARK))
    starts = list(range(n + 1))
    agenda = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
    while agenda:
        best = min(agenda)
        if best == never:
            break
        i = agenda.index(best)
        # the coin of ``skipped``, by its tables
        places = LEFT[starts[i]] ^ RIGHT[starts[i + 1]] ^ END[starts[i + 2]]
        if limit and coin(key ^ places) < limit:
            agenda[i] = never
            continue
        parts[i] += parts[i + 1]
        del parts[i + 1], starts[i + 1], agenda[i]
        if i < len(agenda):
            agenda[i] = rank(parts[i] + parts[i + 1], never)
        if i:
            agenda[i - 1] = rank(parts[i - 1] + parts[i], never)
    return parts


def _merge_long(word: str, vocabulary: Vocabulary, key: int, limit: int) -> list[str]:
    """The same with a heap, for words of any length and with literal marks.

    A literal mark must not be read as a space: it stays a part of its own, under a
    private name that has no piece.
    """
    rank = vocabulary.ranks.get
    parts: list[str | None] = [MARK if c == " " else c for c in word]
    n = len(parts)
    literal = [c == MARK for c in word]
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[float, int, int, str]] = []

    def propose(a: int, b: int) -> None:
        if not (literal[a] or literal[b]):
            joined = parts[a] + parts[b]
            found = rank(joined)
            if found is not None:
                heapq.heappush(agenda, (found, a, b, joined))

    for i in range(n - 1):
        propose(i, i + 1)
    while agenda:
        _, a, b, joined = heapq.heappop(agenda)
        left, right = parts[a], parts[b]
        if left is None or right is None or following[a] != b or left + right != joined:
            continue  # one of its parts has been merged since
        end = following[b]
        if limit and skipped(key, limit, a, b, end):
            continue
        parts[a], parts[b] = joined, None
        following[a] = end
        if end < n:
            previous[end] = a
            propose(a, end)
        if previous[a] >= 0:
            propose(previous[a], a)
    out, at = [], 0
    while at < n:
        out.append(LITERAL if literal[at] else parts[at])
        at = following[at]
    return out


def lockstep(
    codes: np.ndarray, vocabulary: Vocabulary, keys: np.ndarray | None, limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, alive)``, places by words: what the agendas of words of one length leave.

    ``codes`` are their characters, a row a word; ``keys`` their coin keys.
    """
    pairs = vocabulary.pairs
    n, size = codes.shape[1], len(codes)
    symbols = np.ascontiguousarray(vocabulary.symbols[codes].T)
    alive = np.ones((n, size), bool)
    if n == 1:
        return symbols, alive
    agenda = np.full((n, size), DONE, np.int32)
    for place in range(n - 1):
        agenda[place] = pairs.entries(symbols[place], symbols[place + 1], place)
    # where the next part begins, which is where a part ends; and the one before
    following = np.repeat(np.arange(1, n + 1, dtype=np.int8)[:, None], size, axis=1)
    previous = np.repeat(np.arange(-1, n - 1, dtype=np.int8)[:, None], size, axis=1)
    kept_symbols, kept_alive = symbols.copy(), alive.copy()
    word = np.arange(size)
    left_of, right_of, end_of = (np.array(t, np.uint64) for t in (LEFT, RIGHT, END))
    while True:
        best = agenda.min(axis=0)
        going = best != DONE
        if not going.all():
            over = np.flatnonzero(~going)
            kept_symbols[:, word[over]] = symbols[:, over]
            kept_alive[:, word[over]] = alive[:, over]
            left = np.flatnonzero(going)
            if not len(left):
                return kept_symbols, kept_alive
            word, best = word[left], best[left]
            symbols, alive, agenda, following, previous = (
                np.take(x, left, axis=1) for x in (symbols, alive, agenda, following, previous)
            )
        at = best & ((1 << PLACE_BITS) - 1)
        column = np.arange(len(word))
        right = following[at, column].astype(np.int64)
        end = following[right, column].astype(np.int64)
        if limit:
            places = left_of[at] ^ right_of[right] ^ end_of[end]
            skip = coins(keys[word] ^ places) < limit
            agenda[at[skip], column[skip]] = DONE
            column = np.flatnonzero(~skip)
            at, right, end = at[column], right[column], end[column]
        found = pairs.find(symbols[at, column], symbols[right, column])
        merged = pairs.made[found]
        symbols[at, column] = merged
        alive[right, column] = False
        agenda[right, column] = DONE
        following[at, column] = end
        # with the part that comes next, and with the one before
        entry = np.full(len(column), DONE, np.int32)
        inner = np.flatnonzero(end < n)
        c, here, there = column[inner], at[inner], end[inner]
        previous[there, c] = here
        entry[inner] = pairs.entries(merged[inner], symbols[there, c], here)
        agenda[at, column] = entry
        before = previous[at, column].astype(np.int64)
        inner = np.flatnonzero(before >= 0)
        c, here = column[inner], before[inner]
        agenda[here, c] = pairs.entries(symbols[here, c], merged[inner], here)


class Encoder:
    """Encodes texts; one lives in each Python worker."""

    def __init__(self, model: bytes, seed: int, rate: float):
        self.vocabulary = Vocabulary(model)
        self.seed = seed
        self.limit = int(rate * 2**32)

    def encode(self, text: str, key: int) -> np.ndarray:
        """Piece ids of a text; ``key`` tells documents apart."""
        return self.encode_all([text], [key])[0]

    def encode_all(self, texts: Sequence[str], keys: Sequence[int]) -> list[np.ndarray]:
        """Piece ids of several texts."""
        words = [WORD.findall(" " + text) if text else [] for text in texts]
        flat = list(chain.from_iterable(words))
        if self.limit:
            coded = [word_keys(coin_key(self.seed, k), len(w)) for k, w in zip(keys, words)]
            found, counts = self._run(flat, np.concatenate(coded) if coded else None)
        else:
            once = dict.fromkeys(flat)
            place = {w: i for i, w in enumerate(once)}
            found, counts = self._run(list(once), None)
            found, counts = _repeated(found, counts, [place[w] for w in flat])
        ends = np.cumsum(counts)
        last = np.cumsum([len(w) for w in words])
        cuts = [int(ends[i - 1]) if i else 0 for i in last.tolist()]
        return [found[a:b] for a, b in zip([0, *cuts], cuts)]

    def _run(self, words: list[str], keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of words, one after another, and how many each has."""
        v, limit = self.vocabulary, self.limit
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        alone = sizes > SHORT
        joined = "".join(words)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        if MARK in joined:
            marks = np.flatnonzero(codes == ord(MARK))
            alone[np.searchsorted(begins, marks, "right") - 1] = True
        parts = []  # (words, their counts, ids)
        for i in np.flatnonzero(alone).tolist():
            ids = encode_word(words[i], v, int(keys[i]) if limit else 0, limit)
            parts.append((np.array([i]), np.array([len(ids)]), np.array(ids, np.int32)))
        order = np.flatnonzero(~alone)
        order = order[np.argsort(sizes[order], kind="stable")]
        for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            if len(group):
                letters = codes[begins[group][:, None] + np.arange(sizes[group[0]])]
                own = keys[group] if limit else None
                symbols, alive = lockstep(letters, v, own, limit)
                which, at = np.nonzero(alive.T)
                parts.append((group, *self._spelled(symbols[at, which], which, len(group))))
        counts = np.zeros(len(words), np.int64)
        for group, n, _ in parts:
            counts[group] = n
        out = np.empty(int(counts.sum()), np.int32)
        first = np.cumsum(counts) - counts
        for group, n, ids in parts:
            inside = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(first[group], n) + inside] = ids
        return out, counts

    def _spelled(self, symbols: np.ndarray, which: np.ndarray, n: int):
        """Counts by word and piece ids, characters without a piece as bytes."""
        lost = np.flatnonzero(symbols >= BASE)
        if not len(lost):
            return np.bincount(which, minlength=n), symbols.astype(np.int32)
        spelled = [
            [self.vocabulary.byte_ids[b] for b in chr(c - BASE).encode()]
            for c in symbols[lost].tolist()
        ]
        times = np.ones(len(symbols), np.int64)
        times[lost] = [len(b) for b in spelled]
        out = np.repeat(symbols, times)
        starts = (np.cumsum(times) - times)[lost]
        at = np.concatenate([np.arange(s, s + len(b)) for s, b in zip(starts.tolist(), spelled)])
        out[at] = list(chain.from_iterable(spelled))
        return np.bincount(np.repeat(which, times), minlength=n), out.astype(np.int32)


def _repeated(found: np.ndarray, counts: np.ndarray, picks: list[int]):
    """The ids of the picked words, one after another, and their counts."""
    picks = np.array(picks, np.int64)
    n = counts[picks]
    first = (np.cumsum(counts) - counts)[picks]
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return found[np.repeat(first, n) + inside], n


def _chunks(texts: Sequence[str]) -> Iterator[slice]:
    """Runs of texts of about ``CHUNK`` characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK or i + 1 == len(texts):
            yield slice(start, i + 1)
            start, size = i + 1, 0


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(key: tuple, shared) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, *key[1:])
    return _ENCODERS[key]


def encode(
    docs: DataFrame,
    model: str,
    rate: float = DROPOUT,
    seed: int = SEED,
    ids: bool = True,
) -> DataFrame:
    """Add ``n_pieces``, ``n_byte_pieces`` (long), ``pieces_crc32`` (of the ids as little-endian
    32-bit numbers), ``lossless`` (decoding gave the text back) and, if asked, ``pieces``.

    ``model`` is the path of a SentencePiece file, read on the driver.
    """
    spark = session(docs.sparkSession)
    with open(model, "rb") as file:
        content = file.read()
    shared = spark.sparkContext.broadcast(content)
    key = (hashlib.sha256(content).hexdigest(), seed, rate)
    added = "n_pieces long, n_byte_pieces long, pieces_crc32 long, lossless boolean"
    names = ["n_pieces", "n_byte_pieces", "pieces_crc32", "lossless", "pieces"]
    kept = docs.drop(*names)
    schema = schema_with(kept, added + (", pieces array<int>" if ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared)
        vocabulary = encoder.vocabulary
        is_byte = np.zeros(len(vocabulary.pieces), bool)
        is_byte[list(vocabulary.bytes)] = True
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            keys = [
                xxhash.xxh64_intdigest(text.encode()) if doc is None else doc
                for doc, text in zip(batch.column("doc_id").to_pylist(), texts)
            ]
            coded = chain.from_iterable(
                encoder.encode_all(texts[part], keys[part]) for part in _chunks(texts)
            )
            rows = []
            for text, numbers in zip(texts, coded):
                rows.append(
                    (
                        len(numbers),
                        int(is_byte[numbers].sum()),
                        zlib.crc32(numbers.astype("<i4").tobytes()),
                        vocabulary.decode(numbers) == text,
                        numbers,
                    )
                )
            kinds = [pa.int64()] * 3 + [pa.bool_(), pa.list_(pa.int32())]
            for k, name in enumerate(names[: 5 if ids else 4]):
                batch = batch.append_column(name, pa.array([r[k] for r in rows], kinds[k]))
            yield batch

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, model: str, pieces: str = "pieces", out: str = "text") -> DataFrame:
    """Add the text of an array of piece ids; NULL for NULL."""
    spark = session(df.sparkSession)
    with open(model, "rb") as file:
        content = file.read()
    shared = spark.sparkContext.broadcast(content)
    key = (hashlib.sha256(content).hexdigest(), 0, 0.0)
    kept = df.select(*[F.col(c) for c in df.columns if c != out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(key, shared).vocabulary
        for batch in batches:
            texts = [
                None if p is None else vocabulary.decode(p) for p in batch.column(pieces).to_pylist()
            ]
            yield batch.append_column(out, pa.array(texts, pa.string()))

    return kept.mapInArrow(run, schema_with(kept, f"{out} string"))
