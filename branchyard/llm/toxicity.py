"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities and counts of lexicon words, how close they stand to words of the
second person, capitals, punctuation, obfuscation, and length. The lexicon is a short list of plain
insults and the beginnings of words that are learned from labelled texts: those that stand in
clearly more toxic texts than chance explains. Trees are Spark's own; their score is calibrated by
isotonic regression on labelled rows that neither lexicon nor trees have seen.

Learning uses at most ``max_labelled`` labelled rows, drawn by a hash of their id; that bound is the
only one. Features and scores are of whole texts and of every row.

Rows whose crc32(id as text) modulo 4 is ``held_out`` are never learned from; those with
``calibration`` are for the calibration, the others for lexicon and trees.

Defined results: a null or empty text has all features 0 and a score like any other. Rows without an
id are scored and not learned from. A document with several labels counts as toxic if one of them
says so; null labels are ignored. If the labels to learn from are of one kind or none, every score is
their share of toxic rows, 0 without labels. Other columns of the input stay as they are, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchyard.llm.common import bit_filter, column, passes, python_tasks, stored

MAX_LABELLED = 20_000
#: Entries of the learned lexicon at most, and the evidence (in nats) that each needs.
LEXICON, EVIDENCE = 2_000, 12.0
BEGINNINGS = (5, 6, 7, 9)

#: Plain insults, and words of the second person, without accents.
INSULTS = frozenset(
    """idiot idiots moron morons stupid dumb loser losers trash garbage scum pathetic worthless disgusting clown
    jerk freak creep imbecile cretin fool dimwit vermin filth abruti idiota estupido imbecil
    basura dummkopf trottel abschaum""".split()
)
YOU = frozenset(
    """you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted
    ustedes ti tus""".split()
)
NEAR = 4
PLAIN = str.maketrans("013457@$!", "oieastasi")

WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[^\W\d_]+(?:[0-9@$!*]+[^\W\d_]+)+")
MARKED = re.compile(r"[^\W\d_]([#$%&*@])\1+")


def folded(word: str) -> str:
    """Lower case without accents, so that a word is itself with or without them."""
    word = word.lower()
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def grams(word: str) -> list[str]:
    """What of a word may be a lexicon entry: its beginnings, and the whole with a mark at its end."""
    return [word[:n] for n in BEGINNINGS if len(word) >= n] + [word + "|"]


class Vocabulary(dict):
    """Number of each raw word seen so far, and by number what the features need of it.

    A word is folded and looked up once for all its places. Beyond WORDS_HELD words it starts anew.
    """

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.folded: dict[str, int] = {}
        self.rows: list[tuple] = []  # not yet in the table
        self.table, self.filled = np.zeros((0, 6)), 0

    def __missing__(self, word: str) -> int:
        low = folded(word)
        weight = max((self.lexicon.get(g, 0.0) for g in grams(low)), default=0.0)
        own = self.folded.setdefault(low, len(self.folded))
        self.rows.append((weight, low in INSULTS, low in YOU, len(word), len(word) > 1 and word.isupper(), own))
        number = self[word] = self.filled + len(self.rows) - 1
        return number

    def of(self, words: list[str]) -> np.ndarray:
        """weight, insult, second person, letters, in capitals, number of the folded word; a row a word."""
        if len(self) > WORDS_HELD:
            self.forget()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.rows:
            new = self.filled + len(self.rows)
            if new > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((new, 6))])
            self.table[self.filled : new] = self.rows
            self.filled, self.rows = new, []
        return self.table[at]


#: Words that a task remembers.
WORDS_HELD = 200_000
# the two below are there only where these find something
JOINT = re.compile(r"[0-9@$!*]+(?=[^\W\d_])")
DOUBLED = re.compile(r"([#$%&*@])\1")
NOT_ASCII = re.compile(r"[^\x00-\x7f]")


def capitals(text: str) -> int:
    data = np.frombuffer(text.encode(), np.uint8)
    n = int(((data >= 65) & (data <= 90)).sum())
    return n if text.isascii() else n + sum(map(str.isupper, NOT_ASCII.findall(text)))


def features(text: str, lexicon: Vocabulary | dict[str, float]) -> list[float]:
    """The dense features of a whole text."""
    if not text:
        return [0.0] * N_FEATURES
    words = WORD.findall(text)
    vocabulary = lexicon if isinstance(lexicon, Vocabulary) else Vocabulary(lexicon)
    weight, insult, you, letters_of, shouted, own = vocabulary.of(words).T
    n = len(words)
    insults, strong, weak = insult > 0, weight >= 3, (weight > 0) & (weight < 3)
    hits = np.flatnonzero(insults | strong)
    before = np.concatenate([[0], np.cumsum(you)])
    near = int((before[np.minimum(hits + NEAR + 1, n)] > before[np.maximum(hits - NEAR, 0)]).sum())
    joint = any(m.start() and WORD.match(text[m.start() - 1]) for m in JOINT.finditer(text))
    disguised = DISGUISED.findall(text) if joint else []
    uncovered = sum(folded(w.translate(PLAIN)) in INSULTS for w in disguised)
    marked = MARKED.findall(text) if DOUBLED.search(text) else []
    letters = int(letters_of.sum())
    upper = capitals(text) if letters else 0
    marks = text.count("!") + text.count("?")
    size = max(1, n)
    return [
        insults.sum() / size, float(insults.sum()), strong.sum() / size, float(strong.sum()), weak.sum() / size, float(weak.sum()),
        float(weight.sum()) / size, float(len(np.unique(own[hits]))), near / size, near / max(1, len(hits)),
        upper / max(1, letters), float(shouted.sum()) / size,
        marks / size, (len(text) - letters - text.count(" ")) / len(text),
        len(disguised) / size, float(uncovered), len(marked) / size, math.log1p(n),
    ]


N_FEATURES = 18


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(4)).cast("int")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each possible entry of a text once, with the text's label."""
    for batch in batches:
        for text, toxic in zip(column(batch, "text"), column(batch, "toxic").to_pylist()):
            terms = list({g for w in set(WORD.findall(text.as_py() or "")) for g in grams(folded(w))})
            yield pa.record_batch({"term": pa.array(terms, pa.string()), "toxic": pa.array([toxic] * len(terms), pa.int64())})


def _with_features(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary(lexicon)
    for batch in batches:
        made = [features(text.as_py() or "", vocabulary) for text in column(batch, "text")]
        yield pa.record_batch({"toxic": column(batch, "toxic").cast(pa.float64()), "part": column(batch, "part"), "features": pa.array(made, pa.list_(pa.float64()))})


def _passing(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(passes(bits, column(batch, "doc_id").to_numpy(zero_copy_only=False))))


class ToxicityModel:
    """Lexicon, trees and calibration; ``score`` adds columns to documents."""

    def __init__(self, lexicon: dict[str, float], trees, calibration, share: float) -> None:
        self.lexicon, self.trees, self.calibration, self.share = lexicon, trees, calibration, share

    def score(self, docs: DataFrame, *, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
        """(row struct<all columns of docs>, score double, predicted int)."""
        python_tasks(docs.sparkSession)
        rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
        if self.trees is None:
            scored = rows.withColumn("score", F.lit(self.share))
        else:
            lexicon = self.lexicon

            def all_features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
                vocabulary = Vocabulary(lexicon)
                for texts in batches:
                    yield pd.Series([features(text or "", vocabulary) for text in texts])

            made = F.pandas_udf(all_features, "array<double>")
            rows = rows.select("row", array_to_vector(made("text")).alias("features"))
            scored = calibrated(self.trees, self.calibration, rows)
        return scored.select("row", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def calibrated(trees, calibration, rows: DataFrame) -> DataFrame:
    """Adds score; a thousandth of it is the trees' own, which orders rows that the calibration makes equal."""
    rows = trees.transform(rows).withColumn("raw", F.get(vector_to_array("probability"), F.lit(1)))
    rows = calibration.transform(rows) if calibration else rows.withColumn("calibrated", F.col("raw"))
    score = 0.999 * F.col("calibrated") + 0.001 * F.col("raw")
    return rows.withColumn("score", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out: int = 2,
    calibration: int = 3,
    max_labelled: int = MAX_LABELLED,
    max_lexicon: int = LEXICON,
) -> ToxicityModel:
    """Fits lexicon, trees and calibration to at most ``max_labelled`` labelled rows; at most ``max_lexicon`` entries are learned."""
    python_tasks(docs.sparkSession)
    ids = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.withColumn("part", fold(F.col("doc_id"))).where(F.col("part") != held_out)
    ids = stored(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "labelled")
    bits = bit_filter(ids, "doc_id")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    texts = texts.mapInArrow(partial(_passing, bits=bits), "doc_id long, text string")
    rows = stored(ids.join(texts, "doc_id"), "labelled-texts")
    fitting = rows.where(F.col("part") != calibration)
    by_use = rows.groupBy((F.col("part") == calibration).alias("calibrates"), (F.col("toxic") > 0).alias("is_toxic")).count()
    n = {(row["calibrates"], row["is_toxic"]): row["count"] for row in by_use.collect()}  # four rows at most
    n_toxic, n_clean = n.get((False, True), 0), n.get((False, False), 0)
    if not n_toxic or not n_clean:
        return ToxicityModel({}, None, None, sum(k for (_, toxic), k in n.items() if toxic) / max(1, sum(n.values())))
    lexicon = learned_lexicon(fitting, n_toxic, n_clean, max_lexicon)
    made = rows.select("text", "toxic", "part").mapInArrow(lambda batches: _with_features(batches, lexicon), "toxic double, part int, features array<double>")
    made = stored(made.select("toxic", "part", "features"), "labelled-features").select("toxic", "part", array_to_vector("features").alias("features"))
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=30, maxDepth=3, stepSize=0.2, seed=1).fit(made.where(F.col("part") != calibration).repartition(4, "features"))
    seen = made.where(F.col("part") == calibration)
    curve = None
    if n.get((True, True)) and n.get((True, False)):
        raw = trees.transform(seen).select("toxic", F.get(vector_to_array("probability"), F.lit(1)).alias("raw"))
        curve = IsotonicRegression(labelCol="toxic", featuresCol="raw", predictionCol="calibrated").fit(raw)
    return ToxicityModel(lexicon, trees, curve, 0.0)


def learned_lexicon(rows: DataFrame, n_toxic: int, n_clean: int, most: int = LEXICON) -> dict[str, float]:
    """Entries and weights (log odds) of terms that toxic texts have more often than chance explains.

    The terms are counted in Spark over all given rows; at most ``most`` entries are returned.
    """
    base = n_toxic / (n_toxic + n_clean)
    terms = rows.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(_terms, "term string, toxic long")
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")).where((F.col("a") >= 4) & (F.col("a") > F.col("n") * base))
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    clean = F.when(n > a, (n - a) * F.log((n - a) / (n * (1 - base)))).otherwise(0.0)
    odds = F.log(((a + 0.5) / (n_toxic + 1)) / ((n - a + 0.5) / (n_clean + 1)))
    scored = counts.select("term", (a * F.log(a / (n * base)) + clean).alias("evidence"), odds.alias("odds")).where((F.col("evidence") >= EVIDENCE) & (F.col("odds") >= 1))
    return {row["term"]: row["odds"] for row in scored.orderBy(F.desc("evidence"), "term").limit(most).collect()}


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    held = options.get("held_out", 2)
    model = learn(docs, labels, id_col=id_col, text_col=text_col, **options)
    scored = model.score(docs.select(id_col, text_col), text_col=text_col, threshold=threshold)
    own = F.col("row")[id_col]
    return scored.select(own.alias("doc_id"), F.coalesce(fold(own) == held, F.lit(False)).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, text_col: str = "text", **options) -> DataFrame:
    """The documents with all their columns, but for those with a score of the threshold or more."""
    model = learn(docs, labels, text_col=text_col, **options)
    return model.score(docs, text_col=text_col, threshold=threshold).where("predicted = 0").select("row.*")
