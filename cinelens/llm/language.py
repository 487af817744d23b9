"""Language identification in two levels: the family first, then the languages within it.

A linear support vector machine for every pair of families votes on the
family; within it, one for every pair of languages votes on the language.
Features are hashed character trigrams of the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, mix, slices

#: Learned rows per language at most (those with the smallest hash of their id); bounds what reaches the driver.
PER_LANGUAGE = 300
#: Length of a feature vector.
FEATURES = 4096
#: The fold that is held out: crc32 of the id as text, modulo FOLDS, is HELD_OUT.
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
EPOCHS, COST = 30, 10.0

# --- fixed values: families of common language codes ----------------------------------
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "fo", "fy", "af", "lb", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la", "ast", "sc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "baltic": ["lt", "lv"],
    "celtic": ["ga", "gd", "cy", "br"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "ky", "uz", "tk", "tt"],
    "indic": ["hi", "mr", "ne", "bn", "gu", "pa", "ur", "si"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "semitic": ["ar", "he", "am", "mt"],
    "austronesian": ["id", "ms", "jv", "tl", "mg"],
    "dravidian": ["ta", "te", "kn", "ml"],
    "sinitic": ["zh", "yue", "wuu"],
}
# --------------------------------------------------------------------------------------


def family(lang: str) -> str:
    """Family of a code; a code of no listed family stands alone."""
    return next((f for f, codes in FAMILIES.items() if lang.lower() in codes), lang)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


#: Bytes that are not letters count as spaces: ASCII digits, signs and white space.
_PLAIN = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))
_MULT = [int(m) for m in mix(np.arange(11, 14, dtype=U64)) | U64(1)]


def features(text: str | None) -> np.ndarray | None:
    """Square roots of trigram shares (a unit vector); None without a letter."""
    if not text or not any(c.isalpha() for c in text):
        return None
    words = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split())
    b = np.frombuffer(b" " + words + b" ", dtype=np.uint8).astype(U64)
    if len(b) < 3:
        return None
    h = b[:-2] * U64(_MULT[0]) + b[1:-1] * U64(_MULT[1]) + b[2:] * U64(_MULT[2])
    spot = ((h ^ (h >> U64(29))) * U64(_MULT[0])) >> U64(64 - int(FEATURES).bit_length() + 1)
    return np.sqrt(np.bincount(spot.astype(np.int64), minlength=FEATURES) / len(h))


def _vectors(batches):
    for batch in slices(batches):
        vecs = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if v is None else v.astype(np.float32).tobytes() for v in vecs], pa.binary())],
            names=["lang", "vec"])


def linear_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (last one the bias) of a linear SVM by dual coordinate descent; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha, norm = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(axis=1)
    cost = COST * len(x) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(x)):
            a = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / norm[i], 0), cost[i])
            if a != alpha[i]:
                w += (a - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(a - alpha[i]))
                alpha[i] = a
        if moved < 1e-3:
            break
    return w


class Model:
    """Pairwise machines over families, and over the languages of each family."""

    def __init__(self, rows: list[tuple[str, np.ndarray]]):
        self.members: dict[str, list[str]] = {}
        for lang in sorted({lang for lang, _ in rows}):
            self.members.setdefault(family(lang), []).append(lang)
        x = np.array([v for _, v in rows]) if rows else np.zeros((0, FEATURES))
        langs = np.array([lang for lang, _ in rows])
        kinds = np.array([family(lang) for lang, _ in rows])
        self.levels = {None: self._pairs(x, kinds, list(self.members))}
        for fam, codes in self.members.items():
            sel = kinds == fam
            self.levels[fam] = self._pairs(x[sel], langs[sel], codes)

    @staticmethod
    def _pairs(x, names, classes):
        pairs = [(a, b) for i, a in enumerate(classes) for b in classes[i + 1:]]
        weights = []
        for a, b in pairs:
            sel = (names == a) | (names == b)
            weights.append(linear_svm(x[sel], np.where(names[sel] == a, 1.0, -1.0)))
        return classes, pairs, np.array(weights).astype(np.float32) if weights else None

    def _vote(self, level, v: np.ndarray) -> tuple[str, float]:
        """Class with the most pairwise wins (then the larger margins); share of its probabilities."""
        classes, pairs, weights = self.levels[level]
        if not pairs:
            return classes[0], 1.0
        margin = weights[:, :-1] @ v + weights[:, -1]
        chance = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
        wins, total = dict.fromkeys(classes, 0), dict.fromkeys(classes, 0.0)
        for (a, b), m, p in zip(pairs, margin, chance):
            wins[a if m >= 0 else b] += 1
            total[a] += p
            total[b] += 1 - p
        best = max(classes, key=lambda c: (wins[c], total[c]))
        return best, float(total[best] / (len(classes) - 1))

    def predict(self, text: str | None) -> tuple[str, float]:
        v = features(text)
        if v is None or not self.members:
            return UNKNOWN, 0.0
        v = v.astype(np.float32)
        fam, p = self._vote(None, v)
        lang, q = self._vote(fam, v)
        return lang, min(1.0, max(0.0, p * q))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Model from at most ``per_language`` labelled rows a language outside the held-out fold.

    The rows are chosen by a hash of the id alone (``WindowGroupLimit`` keeps
    at most that many per language and task before the shuffle); their whole
    texts become vectors in the tasks, and only vectors reach the driver.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out(F.col("doc_id"))).select("doc_id", "lang")
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= per_language).select(
        F.col("doc_id").alias("__id"), F.col("lang").alias("__lang")).distinct()
    texts = docs.select("doc_id", "text", "lang").join(
        chosen, (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang"))).select("lang", "text")
    got = texts.mapInArrow(_vectors, "lang string, vec binary").where("vec is not null").collect()
    data = sorted((r["lang"], bytes(r["vec"])) for r in got)
    return Model([(lang, np.frombuffer(v, dtype=np.float32).astype(np.float64)) for lang, v in data])


def _predict(model: Model):
    def run(batches):
        for batch in slices(batches):
            got = [model.predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=batch.schema.names[:-1] + ["lang_pred", "score"])
    return run


def with_language(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score`` of its column ``text``."""
    cols = docs.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields[:-1])
    return cols.mapInArrow(_predict(model), f"{kinds}, lang_pred string, score double")


def _lettered(at: int):
    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array([features(t) is not None for t in batch.column(at).to_pylist()], pa.bool_()))
    return run


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text has a letter, which is all that ``identify`` needs to tell a language once it has learned any."""
    return docs.mapInArrow(_lettered(docs.columns.index(text)), docs.schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs (doc_id, text, lang, ...)``.

    Learns from text and non-null lang outside the held-out fold; a
    prediction reads the whole text alone. ``und`` with score 0 where the text
    is null or has no letter, or nothing could be learned. ``held_out`` is
    false for a null doc_id, which is not learned from. Repeated rows are
    predicted alike; an empty table gives an empty result; other columns are
    ignored.
    """
    model = train(docs, per_language)
    return with_language(docs, model, ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                                                         "lang_pred", "score")
