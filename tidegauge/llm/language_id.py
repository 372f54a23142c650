"""Language identification in two steps: the family first, then the language inside it.

A text is its byte trigrams, hashed; a feature is the root of a trigram's share. A linear support
vector machine per family says whether a text belongs to it; inside the best family one machine for
each two languages tells these two apart, and most won comparisons decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.tables import settle

UNKNOWN = "und"
BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
BYTES_AT_ONCE = 1 << 20
#: Texts to learn from, per language: at most so many, whatever the size of the table. The driver
#: holds their features, 32 kB each.
SAMPLE = 400
ROUNDS = 300
PENALTY = 1e-4
#: Steepness of the curve that turns a margin into a probability.
STEEPNESS = 4.0

# Families of languages by their ISO 639 codes. Others are families of their own.
FAMILIES = {
    "Germanic": "en de nl af sv da no nb nn is fy lb yi",
    "Romance": "fr es it pt ro ca gl oc",
    "Slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "Baltic": "lt lv",
    "Celtic": "ga gd cy br",
    "Uralic": "fi et hu",
    "Turkic": "tr az kk uz ky tk tt",
    "Indo-Aryan": "hi ur bn pa mr gu ne si",
    "Dravidian": "ta te kn ml",
    "Semitic": "ar he mt am",
    "Iranian": "fa ps ku tg",
    "Malayo-Polynesian": "id ms tl jv su",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# Bytes as features see them: A-Z lowered, other ASCII than letters a space.
PLAIN = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


# Fixed value: what `str.isalpha` calls a letter.
LETTER = r"\p{L}"


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


def has_letter(text: str | None) -> bool:
    return text is not None and next(filter(str.isalpha, text), None) is not None


def features(text: str) -> np.ndarray:
    """The roots of the shares of hashed trigrams: a vector of length one, over the whole text."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(PLAIN) + b" ", np.uint8)
    counts = np.zeros(BUCKETS)
    for start in range(0, len(raw) - 2, BYTES_AT_ONCE):
        part = raw[start : start + BYTES_AT_ONCE + 2].astype(np.uint32)
        gram = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(0x9E3779B1)
        counts += np.bincount(gram >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


class Machine(NamedTuple):
    """One linear machine: positive for `yes`."""

    yes: str
    no: str | None
    weights: np.ndarray
    bias: float


class Model(NamedTuple):
    families: list[Machine]
    pairs: list[Machine]
    members: dict[str, list[str]]


def train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by accelerated descent; y is 1 or -1.

    Both classes weigh the same, however many texts they have.
    """
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    # The last weight is the bias.
    w = ahead = np.zeros(x.shape[1] + 1, dtype=np.float32)
    step = 1 / (4 + PENALTY)
    for i in range(ROUNDS):
        pull = 2 * share * y * np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        new = ahead - step * (PENALTY * ahead - np.append(pull @ x, pull.sum()))
        ahead, w = new + i / (i + 3) * (new - w), new
    return w[:-1], float(w[-1])


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """Machines for the families, and for each two languages inside one."""
    langs_of = np.array(langs, dtype=object)
    members: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        members.setdefault(family_of(lang), []).append(lang)
    names = np.array([family_of(lang) for lang in langs], dtype=object)
    families = [Machine(f, None, *train(x, np.where(names == f, 1, -1).astype(np.float32))) for f in members]
    pairs = []
    for codes in members.values():
        for a, b in combinations(codes, 2):
            rows = (langs_of == a) | (langs_of == b)
            pairs.append(Machine(a, b, *train(x[rows], np.where(langs_of[rows] == a, 1, -1).astype(np.float32))))
    return Model(families, pairs, members)


def _sure(margin: float) -> float:
    return float(1 / (1 + np.exp(-STEEPNESS * np.clip(margin, -20, 20))))


def predict(model: Model, text: str | None) -> tuple[str, float]:
    """The language of a text and how sure that is, from 0 to 1.

    `und` with 0 for NULL, a text without letters, or where nothing was learned. The best family is
    taken, the first of equals; inside it the language that wins most comparisons, then the one
    that wins them by more. The score is the family's share among all, times the mean certainty of the
    language's comparisons.
    """
    if not model.families or not has_letter(text):
        return UNKNOWN, 0.0
    x = features(text)
    sure = [_sure(float(x @ m.weights) + m.bias) for m in model.families] if len(model.families) > 1 else [1.0]
    best = int(np.argmax(sure))
    score = sure[best] / sum(sure) if sum(sure) else 0.0
    codes = model.members[model.families[best].yes]
    if len(codes) == 1:
        return codes[0], score
    won: dict[str, list[float]] = {code: [] for code in codes}
    for m in model.pairs:
        if m.yes in won:
            p = _sure(float(x @ m.weights) + m.bias)
            won[m.yes].append(p)
            won[m.no].append(1 - p)
    lang = max(codes, key=lambda code: (sum(p > 0.5 for p in won[code]), sum(won[code])))
    return lang, score * sum(won[lang]) / len(won[lang])


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text", sample: int = SAMPLE) -> Model:
    """A model from the rows of `labelled` that have a language and a letter.

    At most `sample` texts of a language are used, those of the least hash, each once, so copies
    neither thin the sample nor fill it: of the different hashes a share that gives about half more than
    wanted, then just as many. A task passes on a text once; no more than the sample reaches the
    driver, as features.
    """
    # Texts without a letter must not take places in the sample; NULL has none.
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(LETTER)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("hash")
    )
    # The order of the draw: low bits first, as the share is taken of them.
    low = F.pmod("hash", F.lit(1 << 30))
    different = settle(rows.select("lang", "hash").distinct(), "hashes")
    sizes = different.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(1.5 * sample + 20) / F.col("n"))
    drawn = different.join(F.broadcast(sizes), "lang").filter(low < share * F.lit(1 << 30))
    by_hash = Window.partitionBy("lang").orderBy(low, "hash")
    chosen = drawn.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= sample).select("lang", "hash")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            langs, hashes, packed = [], [], []
            for code, number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (code, number) in seen:
                    continue
                seen.add((code, number))
                body = body.as_py()
                if has_letter(body):
                    langs.append(code)
                    hashes.append(number)
                    packed.append(features(body).tobytes())
            yield pa.RecordBatch.from_pydict(
                {"lang": langs, "hash": hashes, "features": packed},
                schema=pa.schema([("lang", pa.string()), ("hash", pa.int64()), ("features", pa.binary())]),
            )

    learned = (
        rows.join(F.broadcast(chosen), ["lang", "hash"]).select("lang", "hash", "text")
        .mapInArrow(described, "lang string, hash bigint, features binary")
        .groupBy("lang", "hash").agg(F.min("features").alias("features"))
        .select("lang", "features").collect()
    )
    learned.sort(key=lambda r: (r.lang, bytes(r.features)))
    if not learned:
        return Model([], [], {})
    langs = [r.lang for r in learned]
    x = np.stack([np.frombuffer(r.features, np.float32) for r in learned])
    learned.clear()
    return fit(x, langs)


def identify(body: Column, model: Model) -> Column:
    """struct(lang_pred, score) of a text column, by whole texts."""

    def guess(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([predict(model, t) for t in texts], columns=["lang_pred", "score"])

    guess.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(guess, "lang_pred string, score double")(body)


def identify_documents(
    docs: DataFrame, learning: Column, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score; learns from rows where `learning` holds.

    Held-out rows, ids and sources are never inputs. No shuffle of documents.
    """
    model = learn(docs.filter(learning), lang, text, sample)
    return docs.select(
        F.col(id_column).alias("doc_id"), (~learning).alias("held_out"), identify(F.col(text), model).alias("guess")
    ).select("doc_id", "held_out", "guess.lang_pred", "guess.score")


def known_language(docs: DataFrame, learning: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language can be told, whole rows; NULL and letterless texts go."""
    model = learn(docs.filter(learning), lang, text)
    return docs.filter(identify(F.col(text), model)["lang_pred"] != UNKNOWN)
