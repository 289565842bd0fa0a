"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the frequent byte n-grams of all languages: a slot is a
mask with a bit for each language, and the AND of an n-gram's slots tells every language
that has it, in one look. A text's n-grams are counted per language; the count expected
from false positives alone is taken off, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import map_texts, stored
from tidemark.llm.textbatch import mix, slices, text_bytes

UNKNOWN = "und"
#: Bytes of an n-gram. Letters are lowered; anything between words is one blank.
WIDTH = 4
#: Bounds of the fit: documents of a language, languages, and n-grams of a language.
SAMPLE, GRAMS = 2000, 20_000
#: An n-gram belongs to a language if it is at least this share of the largest there is.
SHARE = 0.2
#: Languages, one row each, that are broadcast.
BROADCAST = 1 << 16
PROBES = 2
_SHOWN = np.full(256, 32, dtype=np.uint8)
_SHOWN[97:123] = np.arange(97, 123)
_SHOWN[65:91] = np.arange(97, 123)
_SHOWN[128:] = np.arange(128, 256)


def ngrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram of every place, as an integer, and the place of each text's first one.

    Texts are padded by blanks; n-grams with two blanks in a row are left out.
    """
    n = len(at) - 1
    size = np.diff(at)
    shown = np.full(len(data) + 2 * n, 32, dtype=np.uint8)
    shown[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, size)] = _SHOWN[data]
    m = max(0, len(shown) - WIDTH + 1)
    gram = np.zeros(m, dtype=np.uint32)
    full = np.ones(m, dtype=bool)
    blank = shown == 32
    double = blank[:-1] & blank[1:]
    for k in range(WIDTH):
        gram = gram << np.uint32(8) | shown[k : k + m]
        if k < WIDTH - 1:
            full &= ~double[k : k + m]
    place = np.flatnonzero(full)
    return gram[place], np.searchsorted(place, at + 2 * np.arange(n + 1))


def _probes(gram: np.ndarray, slots: int) -> list[np.ndarray]:
    h = mix(gram.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    last = np.uint64(slots - 1)
    return [(h >> np.uint64(20 * i) & last).astype(np.int64) for i in range(PROBES)]


@dataclass(frozen=True)
class Model:
    """languages[i] has bit i % 64 of the masks in layer i // 64."""

    languages: tuple[str, ...]
    layers: tuple[np.ndarray, ...]
    false_positive: np.ndarray

    @staticmethod
    def of(grams: dict[str, np.ndarray]) -> Model:
        names = tuple(sorted(grams))
        most = sum(len(g) for g in grams.values())
        slots = min(1 << 20, max(1 << 12, 1 << int(8 * most).bit_length()))
        layers = []
        for low in range(0, max(1, len(names)), 64):
            part = names[low : low + 64]
            kind = np.uint8 if len(names) <= 8 else np.uint64
            mask = np.zeros(slots, dtype=kind)
            for i, name in enumerate(part):
                for slot in _probes(grams[name], slots):
                    mask[slot] |= kind(1 << i)
            layers.append(mask)
        fill = [
            (layers[i // 64] >> layers[0].dtype.type(i % 64) & layers[0].dtype.type(1)).mean()
            for i in range(len(names))
        ]
        return Model(names, tuple(layers), np.array(fill) ** PROBES)

    def shares(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each text's n-grams in each language, and their number."""
        gram, first = ngrams(*text_bytes(column))
        size = np.diff(first)
        out = np.zeros((len(size), len(self.languages)))
        if not len(gram):
            return out, size
        probes = _probes(gram, len(self.layers[0]))
        for low, layer in zip(range(0, len(self.languages), 64), self.layers, strict=False):
            mask = layer[probes[0]]
            for slot in probes[1:]:
                mask &= layer[slot]
            for i in range(low, min(low + 64, len(self.languages))):
                has = mask >> layer.dtype.type(i - low) & layer.dtype.type(1)
                total = np.concatenate(([0], np.cumsum(has, dtype=np.int64)))
                wrong = self.false_positive[i]
                count = total[first[1:]] - total[first[:-1]]
                out[:, i] = (count - wrong * size) / (1 - wrong if wrong < 1 else 1)
        return np.clip(out / np.maximum(size, 1)[:, None], 0, 1), size

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        shares, _ = self.shares(column)
        names, scores = [], []
        best = shares.argmax(axis=1).tolist() if self.languages else [0] * len(column)
        data, at = text_bytes(column)
        letter = np.concatenate(([0], np.cumsum((_SHOWN[data] >= 97) & (data < 128))))
        plain = letter[at[1:]] > letter[at[:-1]]
        for i, k in enumerate(best):
            known = bool(self.languages) and (
                plain[i] or any(map(str.isalpha, column[i].as_py() or ""))
            )
            names.append(self.languages[k] if known else UNKNOWN)
            scores.append(float(shares[i, k]) if known else 0.0)
        return names, scores


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        langs = part.column("lang").to_pylist()
        gram, first = ngrams(*text_bytes(part.column("text")))
        code = {name: i for i, name in enumerate(dict.fromkeys(langs))}
        own = np.repeat(np.array([code[x] for x in langs], dtype=np.uint64), np.diff(first))
        pair, count = np.unique(own << np.uint64(32) | gram, return_counts=True)
        names = list(code)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in (pair >> np.uint64(32)).tolist()], pa.string()),
                pa.array((pair & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                pa.array(count.astype(np.int64)),
            ],
            names=["lang", "gram", "n"],
        )


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    grams: int = GRAMS,
) -> Model:
    """Learns from at most `sample` rows of each language; all languages are learned.

    The rows are those with the smallest hashes of their ids. Of each language the `grams`
    most frequent n-grams count. Null texts and languages teach nothing; without labelled
    rows the model knows no language and answers `und`.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.lit(1)).alias("draw"),
    )
    # Of a large language only hashes that can be among the smallest go on: four times as many
    # as wanted, whatever its size. There is one row per language.
    near = F.least(F.lit(1.0), 4.0 * sample / F.col("count")) * 2.0**64 - 2.0**63
    sizes = stored(rows.groupBy("lang").count(), "languages")
    # The tables of languages go to every task if they are as small as they usually are.
    small = F.broadcast if sizes.count() <= BROADCAST else lambda df: df
    near = small(sizes.select("lang", near.alias("near")))
    by_draw = Window.partitionBy("lang").orderBy("draw")
    drawn = (
        rows.select("lang", "draw")
        .join(near, "lang")
        .where(F.col("draw") <= F.col("near"))
        .withColumn("place", F.row_number().over(by_draw))
        .where(F.col("place") <= sample)
        .groupBy("lang")
        .agg(F.max("draw").alias("last"))
    )
    taught = rows.join(small(drawn), "lang").where("draw <= last").select("lang", "text")
    counts = (
        taught.mapInArrow(_counted, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= grams)
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    shared = top.withColumn("share", share)
    # An n-gram counts for the languages that use it about as much as the one that does most.
    most = shared.groupBy("gram").agg(F.max("share").alias("most"))
    kept = shared.join(most, "gram").where(F.col("share") >= SHARE * F.col("most"))
    kept = stored(kept.select("lang", "gram"), "grams")
    names = sorted(r.lang for r in kept.select("lang").distinct().collect())
    learned: dict[str, np.ndarray] = {}
    # One layer's languages at a time come to the driver.
    for low in range(0, len(names), 64):
        found = kept.where(F.col("lang").isin(names[low : low + 64])).toArrow().to_pandas()
        learned |= {k: g["gram"].to_numpy().astype(np.uint32) for k, g in found.groupby("lang")}
    return Model.of(learned)


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """The columns of `docs` with lang_pred and score (0 to 1, the language's share of n-grams).

    A text that is null or has no letter is `und` with score 0; of equal shares the first
    language by name wins. Columns of these names in `docs` are replaced.
    """

    def work(column: pa.Array) -> list[pa.Array]:
        names, scores = model.predict(column)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return map_texts(docs, text_col, work, "lang_pred string, score double", keep_text)
