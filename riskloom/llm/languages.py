"""Language identification by unigram pieces, with all segmentations of a word summed.

A language is a probability for every piece of a fixed public vocabulary. The probability
of a word is the sum, over all ways of cutting it into pieces, of the product of their
probabilities: a forward pass over the word's lattice. A text's is the product over its
words, so a text is scored once for every language and no segmentation is ever chosen.

Words are runs of letters (with the marks on them) of the lower-cased text, each written
after the vocabulary's word mark. A character that is no piece is spelled by the
vocabulary's byte pieces, as its tokenizer would. Piece probabilities are learned from
labelled texts by expectation maximisation: a forward and a backward pass give the expected
count of every piece over all segmentations; Spark sums them over the distinct words.

The fit uses a hash sample of at most about ``MAX_TRAIN`` labelled texts a language that
are not held out; their words are counted by Spark. The model is a table of languages by
pieces, so its size does not depend on the corpus. Scoring is one pass without a shuffle:
the distinct words of a batch run through their lattices in lockstep, and words of earlier
batches are remembered up to ``MEMO``.

NULL texts and texts without a letter are ``UND`` with score 0. Other texts, of any length
and in any script, get a learned language; the score is its share of the probabilities of
all learned languages, ties going to the first in the order of names. A word of any length
is scored whole. Rows without id are not held out. Labels that are NULL are not learned;
without any labelled text everything is ``UND``. Columns that the input has are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import land, schema_with, session

FOLDS, HELD = 4, 2
MAX_TRAIN = 1_000
HASH_CELLS = 1 << 20
ROUNDS = 3
# weight, in expected pieces, of what all languages share
PRIOR = 50.0
# share of the vocabulary's uniform distribution in that
FLOOR = 0.01
UND = "und"
WORD = r"\p{L}[\p{L}\p{M}]*"
MARK = "▁"
MEMO = 300_000
# characters of the words that run in lockstep
LOCKSTEP = 400_000


def held_out(doc_id: Column) -> Column:
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS == HELD, F.lit(False))


def letter_words(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


class Pieces:
    """A vocabulary as a trie over character classes, walked from many places at once."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = model.get_piece_size()
        texts, self.byte_ids = {}, np.zeros(256, dtype="int64")
        for i in range(self.size):
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                texts[model.id_to_piece(i)] = i
        alphabet = sorted({c for t in texts for c in t})
        self.classes = np.zeros(0x110000, dtype="int16")
        self.classes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.width = len(alphabet) + 1
        nodes, ids = {"": 0}, [-1]
        for text in sorted(texts):
            for end in range(1, len(text) + 1):
                if text[:end] not in nodes:
                    nodes[text[:end]] = len(ids)
                    ids.append(-1)
            ids[nodes[text]] = texts[text]
        self.ids = np.array(ids, dtype="int32")
        edges = [
            (nodes[t[:-1]] * self.width + int(self.classes[ord(t[-1])]), n)
            for t, n in nodes.items()
            if t
        ]
        edges.sort()
        self.edges = np.array([e for e, _ in edges], dtype="int64")
        self.targets = np.array([n for _, n in edges], dtype="int32")

    def follow(self, node: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The node reached from each node by a character class, 0 where there is none."""
        key = node.astype("int64") * self.width + kind
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], 0)


@dataclass
class Lattice:
    """Every piece that fits somewhere in some words.

    Places are the gaps between characters, words one after another; ``step`` is a place's
    distance from its word's beginning. ``piece`` counts on after the vocabulary for
    characters that are spelled in bytes, whose byte pieces ``spelled`` lists.
    """

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    step: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray
    spelled: list[np.ndarray]


def lattice(words: list[str], pieces: Pieces) -> Lattice:
    marked = [MARK + w for w in words]
    sizes = np.array([len(w) for w in marked], dtype="int64")
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = pieces.classes[codes]
    word = np.repeat(np.arange(len(words)), sizes)
    begins = np.cumsum(sizes) - sizes
    ends = (begins + sizes)[word]  # where the word of each character stops
    at = np.arange(len(codes))
    node, starts, lengths, found = np.zeros(len(codes), dtype="int32"), [], [], []
    alone = np.zeros(len(codes), dtype=bool)
    length = 0
    while len(at):
        node = pieces.follow(node, kinds[at + length])
        length += 1
        hit = pieces.ids[node] >= 0
        if length == 1:
            alone[at[hit]] = True
        starts.append(at[hit])
        lengths.append(np.full(int(hit.sum()), length))
        found.append(pieces.ids[node[hit]])
        more = (node > 0) & (at + length < ends[at])
        at, node = at[more], node[more]
    # characters that are no piece
    lost = np.flatnonzero(~alone)
    kinds_lost, which = np.unique(codes[lost], return_inverse=True)
    spelled = [
        pieces.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in kinds_lost.tolist()
    ]
    starts.append(lost)
    lengths.append(np.ones(len(lost), dtype="int64"))
    found.append(pieces.size + which)
    start, size = np.concatenate(starts), np.concatenate(lengths)
    places = start + word[start]
    step = np.concatenate([np.arange(n + 1) for n in sizes.tolist()]) if words else sizes
    firsts = begins + np.arange(len(words))
    return Lattice(
        places, places + size, np.concatenate(found), step, firsts, firsts + sizes, spelled
    )


def with_spelled(logs: np.ndarray, spelled: list[np.ndarray]) -> np.ndarray:
    if not spelled:
        return logs
    return np.concatenate([logs, np.stack([logs[ids].sum(axis=0) for ids in spelled])])


def _sweep(into: np.ndarray, out: np.ndarray, order_by: np.ndarray, weight, total) -> None:
    """Sum ``total[into] + weight`` over the pieces that end at each place ``out``, places
    of one step at a time."""
    order = np.lexsort((out, order_by))
    into, out, weight, by = into[order], out[order], weight[order], order_by[order]
    new_group = np.flatnonzero(np.r_[True, out[1:] != out[:-1]]) if len(out) else out
    group_steps = by[new_group]
    bounds = np.flatnonzero(np.r_[True, group_steps[1:] != group_steps[:-1], True])
    edges = np.r_[new_group, len(out)]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        low, high = edges[a], edges[b]
        values = total[into[low:high]] + weight[low:high]
        total[out[new_group[a:b]]] = np.logaddexp.reduceat(values, new_group[a:b] - low, axis=0)


def forward(lat: Lattice, logs: np.ndarray) -> np.ndarray:
    """Log probability of reaching each place, a column for each of ``logs``."""
    total = np.full((len(lat.step), logs.shape[1]), -np.inf)
    total[lat.firsts] = 0.0
    weight = with_spelled(logs, lat.spelled)[lat.piece]
    _sweep(lat.start, lat.end, lat.step[lat.end], weight, total)
    return total


def backward(lat: Lattice, logs: np.ndarray) -> np.ndarray:
    """Log probability of finishing the word from each place."""
    total = np.full((len(lat.step), logs.shape[1]), -np.inf)
    total[lat.lasts] = 0.0
    weight = with_spelled(logs, lat.spelled)[lat.piece]
    _sweep(lat.end, lat.start, -lat.step[lat.start], weight, total)
    return total


def expected(words: list[str], n: np.ndarray, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """Expected count of every piece over all segmentations of counted words."""
    lat = lattice(words, pieces)
    ahead, behind = forward(lat, logs)[:, 0], backward(lat, logs)[:, 0]
    weight = with_spelled(logs, lat.spelled)[lat.piece, 0]
    whole = np.repeat(ahead[lat.lasts], lat.lasts - lat.firsts + 1)
    times = np.repeat(n.astype("float64"), lat.lasts - lat.firsts + 1)
    share = np.exp(ahead[lat.start] + weight + behind[lat.end] - whole[lat.start])
    counts = np.bincount(
        lat.piece, share * times[lat.start], minlength=len(logs) + len(lat.spelled)
    )
    for count, ids in zip(counts[len(logs) :], lat.spelled):
        np.add.at(counts, ids, count)
    return counts[: len(logs)]


def in_lockstep(words: list[str]) -> Iterator[np.ndarray]:
    """Indexes of words of like lengths, some ``LOCKSTEP`` characters at a time."""
    sizes = np.array([len(w) + 2 for w in words], dtype="int64")
    order = np.argsort(sizes, kind="stable")
    chunk = np.cumsum(sizes[order]) // LOCKSTEP
    for part in np.split(order, np.flatnonzero(np.diff(chunk)) + 1):
        if len(part):
            yield part


def word_logs(words: list[str], pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, over all its segmentations."""
    out = np.empty((len(words), logs.shape[1]))
    for part in in_lockstep(words):
        lat = lattice([words[i] for i in part.tolist()], pieces)
        out[part] = forward(lat, logs)[lat.lasts]
    return out


# --- fitting -------------------------------------------------------------


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities, pieces by languages."""

    languages: list[str]
    logs: np.ndarray
    model_file: str


def training_words(docs: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """``lang, word, n`` of a bounded sample of the labelled texts of each language."""
    usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id")))
    rows = usable.select("lang", "doc_id", "text")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    cells = F.floor(F.least(F.lit(1.0), F.lit(float(max_rows)) / F.col("n")) * HASH_CELLS)
    # one row a language
    wanted = F.broadcast(sizes.select(F.col("lang").alias("_l"), cells.alias("cells")))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(HASH_CELLS))
    sample = rows.join(wanted, (F.col("lang") == F.col("_l")) & (draw < F.col("cells")))
    each = sample.select("lang", F.explode(letter_words(F.col("text"))).alias("word"))
    return each.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def _expectations(pieces, languages: list[str], logs: np.ndarray):
    schema = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])
    column = {name: k for k, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), logs.shape[0]))
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            home = np.array([column[x] for x in batch.column("lang").to_pylist()], dtype="int64")
            for k in np.unique(home).tolist():
                own = np.flatnonzero(home == k)
                mine = [words[i] for i in own.tolist()]
                for part in in_lockstep(mine):
                    chosen = [mine[i] for i in part.tolist()]
                    sums[k] += expected(chosen, n[own[part]], pieces.value, logs[:, [k]])
        lang, piece = np.nonzero(sums)
        made = [pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(sums[lang, piece])]
        yield pa.RecordBatch.from_arrays(made, schema=schema)

    return run


def probabilities(counts: np.ndarray) -> np.ndarray:
    """Log probabilities (pieces by languages) of expected counts (languages by pieces).

    Every language leans on what all share, and that on the uniform distribution, so no
    piece is impossible.
    """
    totals = counts.sum(axis=1, keepdims=True)
    shares = np.divide(counts, totals, out=np.zeros_like(counts), where=totals > 0)
    shared = shares.mean(axis=0)
    shared = (1 - FLOOR) * shared / max(shared.sum(), 1e-300) + FLOOR / counts.shape[1]
    shared /= shared.sum()
    return np.log((counts + PRIOR * shared) / (totals + PRIOR)).T


def fit(
    docs: DataFrame, model_file: str, max_rows: int = MAX_TRAIN, rounds: int = ROUNDS
) -> LanguageModel:
    """Learn the pieces of every language from ``text`` and ``lang`` alone. Runs jobs.

    Languages are taken to be few (codes): the model has a column for each.
    """
    spark = session(docs.sparkSession)
    words = land(training_words(docs, max_rows), "language-words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    pieces = Pieces(model_file)
    logs = np.full((pieces.size, len(languages)), -np.log(pieces.size))
    shared = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds if languages else 0):
        found = words.mapInArrow(
            _expectations(shared, languages, logs), "lang int, piece int, n double"
        )
        counts = np.zeros(logs.T.shape)
        # a row for each piece and language
        for row in found.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
            counts[row["lang"], row["piece"]] = row["n"]
        logs = probabilities(counts)
    return LanguageModel(languages, logs, model_file)


# --- scoring -------------------------------------------------------------


class Scorer:
    """Texts, as lists of words, to languages; remembers the words it has seen."""

    def __init__(self, pieces: Pieces, model: LanguageModel):
        self.pieces, self.model = pieces, model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.empty((0, len(self.model.languages)))

    def rows_of(self, words: list[str]) -> np.ndarray:
        if len(self.known) > MEMO:
            self.forget()
        new = [w for w in words if w not in self.known]
        if new:
            self.table = np.concatenate([self.table, word_logs(new, self.pieces, self.model.logs)])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        return np.array([self.known[w] for w in words], dtype="int64")

    def score(self, lists: pa.ListArray) -> tuple[list[str], np.ndarray]:
        counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype("int64")
        if not self.model.languages:
            return [UND] * len(counts), np.zeros(len(counts))
        coded = lists.flatten().dictionary_encode()
        rows = self.rows_of(coded.dictionary.to_pylist())
        each = rows[coded.indices.to_numpy(zero_copy_only=False)]
        text = np.repeat(np.arange(len(counts)), counts)
        total = np.stack(
            [np.bincount(text, self.table[each, k], len(counts)) for k in range(self.table.shape[1])],
            axis=1,
        )
        best = total.argmax(axis=1)
        top = total[np.arange(len(total)), best]
        share = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
        names = [self.model.languages[k] if n else UND for k, n in zip(best.tolist(), counts)]
        return names, np.where(counts > 0, share, 0.0)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the rows; both names must be free."""
    spark = session(docs.sparkSession)
    pieces = spark.sparkContext.broadcast(Pieces(model.model_file))
    shared = spark.sparkContext.broadcast(model)
    words = "_letter_words"
    while words in docs.columns:
        words += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pieces.value, shared.value)
        for batch in batches:
            names, score = scorer.score(batch.column(words))
            kept = batch.drop_columns([words])
            kept = kept.append_column("lang_pred", pa.array(names, pa.string()))
            yield kept.append_column("score", pa.array(score, pa.float64()))

    schema = schema_with(docs, "lang_pred string, score double")
    return docs.withColumn(words, letter_words(F.col("text"))).mapInArrow(run, schema)
