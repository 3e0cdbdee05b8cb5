"""Language identification by cross-parsing: phrases found in labelled text of each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editstream.llm.common import packed, python_path, table, unpacked

SAMPLE_DOCS = 64
SAMPLE_CHARS = 24_000
BLOCK = 1_024
LANES = 4_096
UNKNOWN = "und"


def symbols(text: str, codes: np.ndarray | None = None) -> np.ndarray:
    """Code points of the lower-cased text; whatever is no letter counts as a blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points if codes is None else codes[np.minimum(points, len(codes) - 1)]


class SuffixAutomaton:
    """The suffix automaton of a sequence: its paths from state 0 are the sequence's substrings."""

    def __init__(self, sequence: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for symbol in sequence:
            state = self._state(self.length[last] + 1, {}, -1)
            at = last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = state
                at = self.link[at]
            if at < 0:
                self.link[state] = 0
            else:
                old = self.next[at][symbol]
                if self.length[at] + 1 == self.length[old]:
                    self.link[state] = old
                else:
                    copy = self._state(self.length[at] + 1, dict(self.next[old]), self.link[old])
                    while at >= 0 and self.next[at].get(symbol) == old:
                        self.next[at][symbol] = copy
                        at = self.link[at]
                    self.link[old] = self.link[state] = copy
            last = state

    def _state(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def table(self, alphabet: int) -> np.ndarray:
        """Transitions as one array, ``state * alphabet + symbol``; 0 (no path leads back to the
        start) where there is none. States are kept multiplied by ``alphabet``."""
        out = np.zeros(len(self.next) * alphabet, dtype=np.int32)
        for state, after in enumerate(self.next):
            for symbol, to in after.items():
                out[state * alphabet + symbol] = to * alphabet
        return out


class Languages:
    """The automata of all languages over one alphabet, as transition tables."""

    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        letters = sorted({c for t in texts.values() for c in t.lower() if c.isalpha()})
        top = max(map(ord, letters), default=0) + 2
        # Symbol 0 is every blank, 1 every letter that no language has.
        self.codes = np.zeros(0x110000, dtype=np.uint8 if len(letters) < 254 else np.uint32)
        known = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool)
        self.codes[known] = 1
        for i, c in enumerate(letters):
            self.codes[ord(c)] = i + 2
        self.alphabet = len(letters) + 2
        assert top <= len(self.codes)
        self.tables = [
            SuffixAutomaton(self.squeezed(texts[name]).tolist()).table(self.alphabet)
            for name in self.names
        ]

    def squeezed(self, text: str) -> np.ndarray:
        """Symbols of the text, runs of blanks as one."""
        out = self.codes[symbols(text)]
        keep = np.ones(len(out), dtype=bool)
        keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
        return out[keep]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per text and language, and symbols per text.

        Texts are cut into blocks of ``BLOCK`` symbols; all blocks advance side by side, a symbol at
        a time, so a long text costs no more than short ones of the same total length.
        """
        coded = [self.squeezed(t) for t in texts]
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        counts = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        flat = np.concatenate([*coded, np.zeros(0, self.codes.dtype)])
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = begin[owner] + number * BLOCK
        lengths = np.minimum(BLOCK, sizes[owner] - number * BLOCK)
        order = np.argsort(-lengths, kind="stable")
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            self._parse(flat, starts[lanes], lengths[lanes], owner[lanes], counts)
        return counts, sizes

    def _parse(
        self,
        flat: np.ndarray,
        starts: np.ndarray,
        lengths: np.ndarray,
        owner: np.ndarray,
        counts: np.ndarray,
    ) -> None:
        """Greedy phrases of blocks (longest first): the longest known substring, or one symbol."""
        steps = int(lengths[0])
        width = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
        columns = []
        for step in range(steps):
            columns.append(flat[starts[: width[step]] + step].astype(np.int32))
        for language, moves in enumerate(self.tables):
            state = np.zeros(len(starts), dtype=np.int32)
            # A phrase begins at the start of the automaton and where its path ends.
            begun = np.zeros(len(starts), dtype=np.int32)
            root = moves[: self.alphabet]
            for step in range(steps):
                column = columns[step]
                now = state[: width[step]]
                to = moves[now + column]
                begins = np.flatnonzero((now == 0) | (to == 0))
                to[begins] = root[column[begins]]
                begun[begins] += 1
                state[: width[step]] = to
            # A symbol that the language lacks leads back to the start: a phrase of one symbol.
            np.add.at(counts[:, language], owner, begun)


def sampled(labelled: DataFrame, sample_docs: int, sample_chars: int) -> dict[str, str]:
    """Up to ``sample_docs`` texts per language, by hash of the id, and of their symbols at most
    ``sample_chars`` in all, taken evenly from each. Bounded whatever the size of the table."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc"), "doc", "print")
    picked = (
        labelled.select("lang", "doc", F.xxhash64("text").alias("print"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= sample_docs)
        .select(F.col("lang").alias("l"), F.col("doc").alias("d"), F.col("print").alias("p"))
        .distinct()
    )
    share = sample_chars // sample_docs
    rows = (
        labelled.join(
            F.broadcast(picked),  # sample_docs rows per language
            (F.col("lang") == F.col("l"))
            & F.col("doc").eqNullSafe(F.col("d"))
            & (F.xxhash64("text") == F.col("p")),
            "left_semi",
        )
        .select("lang", "doc", F.substring("text", 1, 4 * share).alias("text"))
        .distinct()
        .orderBy("lang", "doc", "text")
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in rows:
        texts.setdefault(row.lang, []).append(row.text)
    out = {}
    for lang, parts in texts.items():
        each = max(share, sample_chars // len(parts))
        out[lang] = "\n".join(t[:each] for t in parts)
    return out


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """The language whose labelled text parses a document into the fewest phrases.

    The suffix automaton of each language's sample (``sample_docs`` texts and ``sample_chars``
    characters at most) gives the longest matches; a text's phrases, greedy and whole, are divided by
    its length. Ties go to the first language by name. ``score`` is the share of phrases saved
    against the second best language, 1 if there is no other. Blocks of 1,024 symbols are parsed one
    by one. A text that is null or has no letter is ``und`` with score 0, and so is every text if
    nothing is labelled. Returns ``row, lang_pred, score``.
    """
    spark = docs.sparkSession
    python_path(spark)
    learn = labelled.select(
        labelled[lang_col].alias("lang"),
        labelled[id_col].alias("doc"),
        labelled[text_col].alias("text"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    texts = sampled(learn, sample_docs, sample_chars)
    shared = spark.sparkContext.broadcast(Languages(texts) if texts else None)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages = shared.value
        for batch in batches:
            found, texts = [UNKNOWN] * len(batch), batch.tolist()
            scores = np.zeros(len(batch))
            some = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            if languages and some:
                counts, sizes = languages.phrases([texts[i] for i in some])
                best = counts.argmin(axis=1)
                least = counts.min(axis=1)
                second = np.partition(counts, 1, axis=1)[:, 1] if counts.shape[1] > 1 else None
                scores[some] = 1.0 if second is None else 1 - least / second
                for i, b in zip(some, best):
                    found[i] = languages.names[b]
            yield pd.DataFrame({"lang_pred": found, "score": scores})

    guess = F.pandas_udf(predict, "lang_pred string, score double")
    rows = packed(docs, id_col, text_col)
    return rows.select("row", guess(F.col("row").getField(text_col)).alias("guess")).select(
        "row", "guess.lang_pred", "guess.score"
    )


def folds(docs: DataFrame) -> DataFrame:
    """The documents that may be learnt from."""
    return docs.where(~_held_out(F.col("doc_id")))


def _held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs.select("doc_id", "text"), folds(docs)).select(
        F.col("row.doc_id").alias("doc_id"),
        _held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )


def in_some_language(docs: DataFrame) -> DataFrame:
    """All columns of the documents in which a language was found."""
    found = identify(docs, folds(docs.select("doc_id", "text", "lang")))
    return unpacked(found.where(F.col("lang_pred") != UNKNOWN), docs.columns)
