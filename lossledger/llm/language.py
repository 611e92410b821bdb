"""Language identification by interpolated Kneser-Ney models over characters, one per language.

Training counts the n-grams of the highest order over all labelled rows; lower orders follow from them as continuation
counts. A model is a set of sorted arrays of n-gram hashes, one per order, with one column of log-probabilities per
language, and the weights with which each context backs off. Models that are too large to share with every task are tables
instead, to which the n-grams of the texts are joined; either way all counts are kept and a text gets the same answer. A
text is scored by its cross-entropy per symbol under each language; the lowest wins. The text is rejected if even that is far above what texts of that language and length have,
by a calibration on all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lossledger.llm.columns import SHORT_SLICE, SLICE_BYTES, slices
from lossledger.llm.hashing import mix
from lossledger.sources.tables import materialise

ORDER = 4
BITS = 12  # of a symbol
UNKNOWN = "und"
#: Log-probabilities (n-grams x languages, four at least) that are shared with every task; larger models are joined as tables.
SHARED_VALUES = 4_000_000
#: Steps in which cross-entropies are summed for the calibration.
STEP = 2.0**-20
#: Standard deviations above the mean cross-entropy of texts of that language and length.
REJECT_BEYOND = 8.0
#: Log-probabilities are multiples of this: sums of them are exact in doubles, so neither the order of rows nor the way a
#: model is stored changes an answer.
GRID = 2.0**-18
_MASK = (1 << BITS) - 1
_LETTERS: list[np.ndarray] = []


def _symbol_table() -> np.ndarray:
    """Code point -> symbol: letters have one, all else is 0. Letters beyond the symbols' range share the upper half."""
    if not _LETTERS:
        points = np.arange(0x33000)
        letter = np.fromiter((chr(c).isalpha() for c in points), bool, len(points))
        folded = np.where(points <= _MASK, points, (_MASK + 1) // 2 + points % ((_MASK + 1) // 2))
        _LETTERS.append(np.where(letter, folded, 0).astype(np.uint64))
    return _LETTERS[0]


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts in a row and each text's number of symbols: letters in lower case, and one 0 for every
    stretch of anything else; each text starts and ends with ``ORDER - 1`` zeros."""
    table = _symbol_table()
    edge = " " * (ORDER - 1)
    padded = [f"{edge}{(t or '').lower()}{edge}." for t in texts]  # the dot is dropped; it keeps the zeros of two texts apart
    joined = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([len(p) for p in padded], dtype=np.int64) - 1
    code = table[np.minimum(joined, len(table) - 1)]
    text_of = np.repeat(np.arange(len(texts)), np.diff(np.r_[-1, ends]))
    inner = np.ones(len(code), bool)
    inner[ends] = False
    # zeros beyond the first of a stretch go, but for those at a text's edges
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    repeated = np.zeros(len(code), bool)
    repeated[1:] = (code[1:] == 0) & (code[:-1] == 0)
    for k in range(ORDER - 1):
        repeated[starts + k] = False
        repeated[ends - 1 - k] = False
    keep = inner & ~repeated
    return code[keep], np.bincount(text_of[keep], minlength=len(texts))


def ngrams(code: np.ndarray) -> np.ndarray:
    """The packed n-gram that ends at each symbol (from the ``ORDER``-th on)."""
    n = len(code) - ORDER + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(ORDER if n > 0 else 0):
        out = out << np.uint64(BITS) | code[k : k + n]
    return out


def _grams_by_text(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams with a letter in them, and the text of each."""
    code, lengths = symbols(texts)
    grams = ngrams(code)
    text = np.repeat(np.arange(len(texts)), lengths)[: len(grams)]
    last = np.repeat(np.arange(len(texts)), lengths)[ORDER - 1 :]
    good = (text == last) & (grams != 0)
    return grams[good], text[good]


def held_out(doc_id: Column) -> Column:
    """Whether a row takes no part in training; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def count_ngrams(labelled: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of (lang, text); each task adds up its own counts first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        pending: dict[str, list[np.ndarray]] = {}

        def fold(lang: str) -> None:
            keys, n = np.unique(np.concatenate(pending.pop(lang)), return_counts=True)
            if lang in total:
                keys, n = np.r_[total[lang][0], keys], np.r_[total[lang][1], n]
                order = np.argsort(keys, kind="stable")
                keys, n = keys[order], n[order]
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                keys, n = keys[first], np.add.reduceat(n, first)
            total[lang] = keys, n

        for batch in slices(batches, most=SHORT_SLICE):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                grams, _ = _grams_by_text([t for g, t in zip(langs, texts) if g == lang])
                if len(grams):
                    pending.setdefault(lang, []).append(grams)
                    if sum(map(len, pending[lang])) > SLICE_BYTES:
                        fold(lang)
        for lang in [*pending]:
            fold(lang)
        for lang, (keys, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    counted = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return counted.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _grouped(keys: np.ndarray, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sum of their values, or how often they occur."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    values = np.ones(len(keys)) if values is None else values[order].astype(float)
    return keys[first], np.add.reduceat(values, first) if len(keys) else values


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[i] == wanted, values[i], missing)


def _on_grid(logs: np.ndarray) -> np.ndarray:
    return np.rint(logs / GRID) * GRID


#: The log-probability of any symbol, where nothing is known.
_FLAT = float(_on_grid(np.array(-math.log(1 << BITS))))


class _KneserNey:
    """One language's model, from its counts of the highest order."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.orders: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # order: n-grams, and their discounted share of their context
        self.backoff: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # order: contexts, and the weight of the next lower order
        keys, counts = grams, n.astype(float)
        for k in range(ORDER, 0, -1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = float(np.clip(ones / (ones + 2 * twos) if ones + twos else 0.5, 0.1, 0.95))
            context = keys >> np.uint64(BITS)
            at, total = _grouped(context, counts)
            _, kinds = _grouped(context)
            self.orders[k] = keys, (counts - discount) / _at(at, total, context, 1.0)
            self.backoff[k] = at, discount * kinds / total
            if k > 1:
                keys, counts = _grouped(keys & np.uint64((1 << BITS * (k - 1)) - 1))

    def probability(self, k: int, keys: np.ndarray) -> np.ndarray:
        if k == 0:
            return np.full(len(keys), 1 / (1 << BITS))
        own = _at(*self.orders[k], keys, 0.0)
        weight = _at(*self.backoff[k], keys >> np.uint64(BITS), 1.0)
        return own + weight * self.probability(k - 1, keys & np.uint64((1 << BITS * (k - 1)) - 1))


@dataclass
class LanguageModels:
    """Sorted hash arrays with a column per language."""

    languages: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # order: hashes, log-probabilities (n-gram x language)
    backoff: dict[int, tuple[np.ndarray, np.ndarray]]  # order: hashes of contexts, log-weights

    @classmethod
    def fit(cls, langs: np.ndarray, grams: np.ndarray, n: np.ndarray) -> LanguageModels:
        languages = sorted(set(langs.tolist()))
        own = [_KneserNey(*_grouped(grams[langs == g].astype(np.uint64), n[langs == g])) for g in languages]
        tables, weights = {}, {}
        for k in range(1, ORDER + 1):
            for out, keys, values in (
                (tables, [m.orders[k][0] for m in own], lambda m, keys, k=k: m.probability(k, keys)),
                (weights, [m.backoff[k][0] for m in own], lambda m, keys, k=k: _at(*m.backoff[k], keys, 1.0)),
            ):
                union = np.unique(np.concatenate(keys)) if own else np.zeros(0, np.uint64)
                hashes = mix(union)
                order = np.argsort(hashes)
                rows = np.stack([_on_grid(np.log(values(m, union))) for m in own], 1).astype(np.float32) if own else np.zeros((0, 0), np.float32)
                out[k] = hashes[order], rows[order]
        return cls(languages, tables, weights)

    def _find(self, table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = mix(keys)
        at = np.minimum(np.searchsorted(table, hashes), max(0, len(table) - 1))
        return at, (table[at] == hashes) if len(table) else np.zeros(len(keys), bool)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per n-gram in nats (text x language), and each text's number of n-grams."""
        grams, text = _grams_by_text(texts)
        n = np.bincount(text, minlength=len(texts))
        sums = np.zeros((len(texts), len(self.languages)))
        keys, rest, k = grams, np.arange(len(grams)), ORDER
        while len(rest):
            if k == 0:
                for j in range(len(self.languages)):
                    sums[:, j] += _FLAT * np.bincount(text[rest], minlength=len(texts))
                break
            hashes, values = self.grams[k]
            at, hit = self._find(hashes, keys)
            contexts, weights = self.backoff[k]
            ctx, known = self._find(contexts, keys[~hit] >> np.uint64(BITS))
            missed = text[rest[~hit]]
            for j in range(len(self.languages)):
                sums[:, j] += np.bincount(text[rest[hit]], values[at[hit], j], len(texts)) if hit.any() else 0
                sums[:, j] += np.bincount(missed[known], weights[ctx[known], j], len(texts)) if known.any() else 0
            rest, keys, k = rest[~hit], keys[~hit] & np.uint64((1 << BITS * (k - 1)) - 1), k - 1
        return -sums / np.maximum(n, 1)[:, None], n


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows whose ``n`` is at least some power of two, the least with which at most ``most`` rows are left."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy(level.alias("level")).count().collect()  # at most 63 rows
    least, total = 0, 0
    for r in sorted(sizes, key=lambda r: -r["level"]):
        total += r["count"]
        if total > most:
            least = r["level"] + 1
            break
    return counts.where(level >= least)


@dataclass
class ModelTables:
    """Models of any size as tables: by n-gram or context, a map from the language's place to its part of the estimate."""

    languages: list[str]
    grams: dict[int, DataFrame]  # order: key, value (discounted share of the context)
    backoff: dict[int, DataFrame]  # order: key (the context), value (weight of the next lower order)

    @classmethod
    def of(cls, counts: DataFrame, languages: list[str]) -> ModelTables:
        place = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
        level = counts.select(place.cast("int").alias("j"), "gram", F.col("n").cast("double").alias("n"))
        grams, backoff = {}, {}

        def by_key(parts: DataFrame) -> DataFrame:
            return parts.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("j", "value"))).alias("value"))

        for k in range(ORDER, 0, -1):
            discounts = [0.5] * len(languages)
            for r in level.groupBy("j").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect():  # a row per language
                if r["ones"] + r["twos"]:
                    discounts[r["j"]] = min(0.95, max(0.1, r["ones"] / (r["ones"] + 2 * r["twos"])))
            discount = F.element_at(F.array(*map(F.lit, discounts)), F.col("j") + 1)
            context = F.shiftright("gram", BITS)
            contexts = level.groupBy("j", context.alias("key")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
            contexts = materialise(contexts, f"language-contexts-{k}")
            backoff[k] = materialise(by_key(contexts.withColumn("value", discount * F.col("kinds") / F.col("total"))), f"language-backoff-{k}")
            shares = level.withColumn("key", context).join(contexts, ["j", "key"]).select("j", F.col("gram").alias("key"), ((F.col("n") - discount) / F.col("total")).alias("value"))
            grams[k] = materialise(by_key(shares), f"language-grams-{k}")
            if k > 1:
                lower = F.col("gram").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1))
                level = materialise(level.groupBy("j", lower.alias("gram")).agg(F.count(F.lit(1)).cast("double").alias("n")), f"language-counts-{k - 1}")
        return cls(languages, grams, backoff)

    def log_probabilities(self, grams: DataFrame) -> DataFrame:
        """``grams`` with ``logp``, an array over the languages."""

        def with_order(k: int) -> Callable[[Column, Column], Column]:
            return lambda lower, j: F.coalesce(F.try_element_at(f"_p{k}", j), F.lit(0.0)) + F.coalesce(F.try_element_at(f"_w{k}", j), F.lit(1.0)) * lower

        def on_grid(x: Column) -> Column:
            return F.rint(F.log(x) / F.lit(GRID)) * F.lit(GRID)

        def with_weight(k: int) -> Callable[[Column, Column], Column]:
            return lambda lower, j: lower + on_grid(F.coalesce(F.try_element_at(f"_w{k}", j), F.lit(1.0)))

        columns, p = grams.columns, F.array_repeat(F.lit(1 / (1 << BITS)), len(self.languages))
        logs = F.array_repeat(F.lit(_FLAT), len(self.languages))
        for k in range(1, ORDER + 1):
            own = F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1))
            for name, table, key, symbols_in_key in ((f"_p{k}", self.grams[k], own, k), (f"_w{k}", self.backoff[k], F.shiftright(own, BITS), k - 1)):
                part = table.select(F.col("key").alias(f"{name}_key"), F.col("value").alias(name))
                # keys of one symbol are at most 4,096
                grams = grams.join(F.broadcast(part) if symbols_in_key < 2 else part, key == F.col(f"{name}_key"), "left").drop(f"{name}_key")
            p = F.transform(p, with_order(k))
            # an n-gram that some language has takes its probability, others the weight of what they fall back on
            logs = F.when(F.col(f"_p{k}").isNotNull(), F.transform(p, on_grid)).otherwise(F.transform(logs, with_weight(k)))
        return grams.select(*columns, F.transform(logs, lambda x: x.cast("float")).alias("logp"))


def fit(docs: DataFrame, shared: int | None = None) -> LanguageModels | ModelTables:
    """Models from all counts of all rows of ``docs`` that have a language and are not held out; as tables if they have
    more than ``shared`` values (by default ``SHARED_VALUES``). Both give the same answers."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = materialise(count_ngrams(labelled), "ngram-counts")
    sizes = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}  # a row per language
    if sum(sizes.values()) * max(4, len(sizes)) > (SHARED_VALUES if shared is None else shared):
        return ModelTables.of(counts, sorted(sizes))
    got = counts.toArrow()
    return LanguageModels.fit(np.array(got["lang"].to_pylist(), dtype=object), got["gram"].to_numpy(), got["n"].to_numpy())


_RESULT = "lang_pred string, score double, entropy double, n_grams long"


def _answers(entropy: np.ndarray, n: np.ndarray, languages: list[str]) -> list[pa.Array]:
    """The columns of ``_RESULT`` from the cross-entropies (text x language) and numbers of n-grams."""
    names = np.array([*languages, UNKNOWN], dtype=object)
    if languages:
        best = np.where(n > 0, entropy.argmin(1), len(languages))
        low = entropy.min(1)
        score = np.where(n > 0, 1 / np.exp((low[:, None] - entropy) * np.minimum(n, 20)[:, None]).sum(1), 0.0)
    else:
        best, low, score = np.zeros(len(n), int), np.zeros(len(n)), np.zeros(len(n))
    return [pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(np.where(n > 0, low, 0.0)), pa.array(n.astype(np.int64))]


def _with_result(batch: pa.RecordBatch, columns: list[str], answers: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in columns), *answers], [*columns, "lang_pred", "score", "entropy", "n_grams"])


def predict(docs: DataFrame, models: LanguageModels | ModelTables) -> DataFrame:
    """``docs`` with lang_pred, score, entropy and n_grams; columns of these names are replaced, all others pass through.

    A null text or one without a letter is ``und`` with score 0. Without any language learned every text is ``und``.
    ``score`` is the winner's share of exp(-cross-entropy x 20), or of fewer n-grams in a shorter text.
    """
    plain = docs.drop("lang_pred", "score", "entropy", "n_grams").withColumn("text", F.col("text").cast("string"))
    result = StructType([*plain.schema.fields, *StructType.fromDDL(_RESULT).fields])
    if isinstance(models, ModelTables):
        return _predict_joined(plain, models, result)
    shared, columns = docs.sparkSession.sparkContext.broadcast(models), plain.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in slices(batches, most=SHORT_SLICE):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield _with_result(batch, columns, _answers(*models.entropies(texts), models.languages))

    return plain.mapInArrow(work, result)


def _predict_joined(plain: DataFrame, models: ModelTables, result: StructType) -> DataFrame:
    """Each n-gram of the texts gets its log-probabilities once. Those of the most frequent n-grams are shared with all
    tasks, so no key of the join of texts and n-grams has many rows; the others are joined, counted within each text."""
    languages, columns = models.languages, plain.columns
    rows = materialise(plain.withColumn("_row", F.monotonically_increasing_id()), "language-rows")  # written, so the ids stay
    counted = count_ngrams(rows.select(F.lit("").alias("lang"), "text")).select("gram", "n")
    known = materialise(models.log_probabilities(counted), "language-vectors")
    frequent = _most_frequent(known, SHARED_VALUES // max(4, len(languages))).select("gram", "logp").toArrow()
    keys, values = frequent["gram"].to_numpy(), np.array(frequent["logp"].combine_chunks().flatten(), np.float32).reshape(-1, len(languages))
    order = np.argsort(keys)
    shared = rows.sparkSession.sparkContext.broadcast((keys[order], values[order]))
    kind = "_row long, gram long, n long, sums array<double>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = shared.value
        for batch in slices(batches, most=SHORT_SLICE):
            ids = batch.column(batch.schema.get_field_index("_row")).to_numpy()
            grams, text = _grams_by_text(batch.column(batch.schema.get_field_index("text")).to_pylist())
            order = np.lexsort((grams, text))
            grams, text = grams[order].astype(np.int64), text[order]
            first = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])]) if len(grams) else np.zeros(0, int)
            n = np.diff(np.r_[first, len(grams)])
            grams, text = grams[first], text[first]
            at = np.minimum(np.searchsorted(keys, grams), max(0, len(keys) - 1))
            hit = keys[at] == grams if len(keys) else np.zeros(len(grams), bool)
            sums = np.stack([np.bincount(text[hit], values[at[hit], j] * n[hit], len(ids)) for j in range(len(languages))], 1)
            total = np.bincount(text, n, len(ids)).astype(np.int64)
            names = ["_row", "gram", "n", "sums"]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(total), pa.array(list(sums), pa.list_(pa.float64()))], names)
            rest = ~hit
            yield pa.RecordBatch.from_arrays([pa.array(ids[text[rest]]), pa.array(grams[rest]), pa.array(n[rest]), pa.nulls(int(rest.sum()), pa.list_(pa.float64()))], names)

    parts = materialise(rows.select("_row", "text").mapInArrow(work, kind), "language-parts")
    rest = parts.where("gram IS NOT NULL").drop("sums").join(known.select("gram", "logp"), "gram")
    rest = rest.withColumn("sums", F.transform("logp", lambda x: x.cast("double") * F.col("n"))).select("_row", F.lit(0).cast("long").alias("n"), "sums")
    every = parts.where("gram IS NULL").select("_row", "n", "sums").unionByName(rest)
    summed = every.groupBy("_row").agg(F.sum("n").alias("_n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(len(languages))]).alias("_sums"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(batch.schema.get_field_index("_n")).to_numpy()
            sums = np.array(batch.column(batch.schema.get_field_index("_sums")).flatten(), float).reshape(-1, len(languages))
            yield _with_result(batch, columns, _answers(-sums / np.maximum(n, 1)[:, None], n, languages))

    return rows.join(summed, "_row").mapInArrow(answer, result)


def calibrate(docs: DataFrame, models: LanguageModels | ModelTables) -> dict[tuple[str, int], float]:
    """The highest cross-entropy that is accepted, by language and length class (log2 of the n-grams), from all training
    rows that are recognised. Cross-entropies are summed as whole steps of ``STEP``, so the order of rows changes no bound."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.select(F.col("lang").cast("string").alias("lang"), "text")
    scored = predict(labelled, models).where("n_grams > 0 AND lang = lang_pred")
    steps = F.rint(F.col("entropy") / F.lit(STEP)).cast("decimal(18,0)")
    stats = scored.groupBy("lang", F.floor(F.log2("n_grams")).cast("int").alias("size")).agg(F.sum(steps).alias("m"), F.sum(steps * steps).alias("s"), F.count(F.lit(1)).alias("n"))
    bounds = {}
    for r in stats.collect():  # a row per language and power of two
        n, total, squares = r["n"], int(r["m"]), int(r["s"])
        deviation = math.sqrt(n * squares - total * total) / n * STEP
        # a class with few rows leaves more room
        bounds[r["lang"], r["size"]] = total / n * STEP + REJECT_BEYOND * max(deviation, 0.05) + 2.0 / math.sqrt(n)
    return bounds


def identify(docs: DataFrame, model_rows: DataFrame | None = None) -> DataFrame:
    """``docs`` with lang_pred, score, entropy, n_grams, held_out and rejected. Models come from ``model_rows`` (by
    default ``docs`` itself): doc_id, lang and text.

    Rejected are ``und`` texts and those whose cross-entropy lies beyond the calibrated bound of their language and
    length. A length without training rows takes the bound of the nearest one.
    """
    source = docs if model_rows is None else model_rows
    models = fit(source)
    bounds = calibrate(source, models)
    table = {}
    for lang in models.languages:
        sizes = sorted(s for g, s in bounds if g == lang)
        for size in range(40):
            table[f"{lang}\0{size}"] = bounds[lang, min(sizes, key=lambda s: abs(s - size))] if sizes else float("inf")
    limit = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.concat_ws("\0", "lang_pred", F.floor(F.log2("n_grams")).cast("string"))] if table else F.lit(None).cast("double")
    out = predict(docs, models).withColumn("held_out", held_out(F.col("doc_id")))
    return out.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | F.coalesce(F.col("entropy") > limit, F.lit(False)))
