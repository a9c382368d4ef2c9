"""Token counts with a shortcut for words that are one token.

``whole_tokens`` proves on the driver, once for a vocabulary, which vocabulary strings
are one pre-token and come out of the merges as one token. Tasks split each whole text
into pre-tokens, count those directly, and run the merges only for the rest, remembering
what they found. The vocabulary has a fixed size and is broadcast as the file's content,
so executors need no file.

Texts of plain Latin characters are normalised and split here; for these characters the
tokenizer's own normaliser and splitter do the same (a test goes through all of them).
Every other text is split by the tokenizer itself, and a text that holds a special
string is encoded by it as a whole. NULL and empty texts have no tokens.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.common import schema_with, session

LIMIT = 2048
# remembered counts of merged pre-tokens in one Python worker
MEMORY = 300_000
# fixed value: the splitting pattern of the vocabulary
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"
# no combining marks, and lower case that depends on nothing around it
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ɏ]*")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


LETTERS = byte_letters()


def spelled(piece: str) -> str:
    return "".join(LETTERS[b] for b in piece.encode())


def whole_tokens(tokenizer: Tokenizer) -> frozenset[str]:
    """Vocabulary strings that, as a pre-token, are exactly one token."""
    back = {c: b for b, c in LETTERS.items()}
    found = set()
    for token in tokenizer.get_vocab(with_added_tokens=False):
        if not token.endswith(END) or any(c not in back for c in token[: -len(END)]):
            continue
        try:
            piece = bytes(back[c] for c in token[: -len(END)]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        alone = PRE_TOKEN.fullmatch(piece) and PRE_TOKEN.findall(piece) == [piece]
        if alone and len(tokenizer.model.tokenize(token[: -len(END)])) == 1:
            found.add(piece)
    return frozenset(found)


class Counts(dict):
    """Token counts by pre-token: the proven ones, and what merging found so far."""

    def __init__(self, tokenizer: Tokenizer, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.tokenizer, self.whole = tokenizer, whole

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.whole) + MEMORY:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = len(self.tokenizer.model.tokenize(spelled(piece)))
        return n


class Counter:
    """Counts tokens of texts; one lives in each Python worker."""

    def __init__(self, source: str, whole: frozenset[str]):
        self.tokenizer = Tokenizer.from_str(source)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.counts = Counts(self.tokenizer, whole)

    def count(self, text: str) -> int:
        if any(s in text for s in self.specials):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if not PLAIN.fullmatch(text):
            return self._count_any(text)
        return sum(map(self.counts.__getitem__, PRE_TOKEN.findall(text.lower())))

    def _count_any(self, text: str) -> int:
        """By the tokenizer's own normaliser and splitter; pieces are spelled already."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(
            self.tokenizer.normalizer.normalize_str(text)
        )
        return sum(len(self.tokenizer.model.tokenize(p)) for p, _ in split)


# by vocabulary digest: workers are reused between queries
_COUNTERS: dict[str, Counter] = {}


def _counter(key: str, shared) -> Counter:
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(*shared.value)
    return _COUNTERS[key]


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", out: str = "n_tokens"
) -> DataFrame:
    """Add the token count (long) of a text column.

    ``vocabulary`` is the path of a tokenizer file, read on the driver.
    """
    spark = session(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()
    tokenizer = Tokenizer.from_str(content)
    shared = spark.sparkContext.broadcast((content, whole_tokens(tokenizer)))
    key = hashlib.sha256(content.encode()).hexdigest()
    kept = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(key, shared)
        for batch in batches:
            counts = [counter.count(t) if t else 0 for t in batch.column(text).to_pylist()]
            yield batch.append_column(out, pa.array(counts, pa.int64()))

    return kept.mapInArrow(run, schema_with(kept, f"{out} long"))


def over(limit: int = LIMIT, column: str = "n_tokens") -> Column:
    return F.col(column) > limit
