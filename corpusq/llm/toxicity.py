"""Toxicity by a convolutional text classifier, trained in numpy inside Spark tasks.

Words are hashed into buckets with embeddings; filters of several widths run over a
text, each keeps its greatest value, and a logistic unit reads those. All labelled rows are dealt into parts by
a hash of their id. In each epoch every part trains from the common weights on its own rows, and the parts' weights
are averaged by Spark; the driver holds one model, whose size is bounded by the buckets. Scoring is one pass over all
texts without a shuffle.

Scores are calibrated on a fifth of the labelled rows that training does not see. Thresholds by
language come from the same rows; the language is never an input of a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.llm.common import bound_batches, map_arrow, written
from corpusq.llm.decontaminate import tokenise
from corpusq.sources.materialise import shuffles_dropped

BUCKETS = 1 << 18
#: Labelled rows of a part, about, and the words after which a part is cut in two.
PART_ROWS = 8_192
PART_WORDS = 8_000_000
#: Texts of a gradient step, and the words after which a step is closed early.
STEP_TEXTS = 64
STEP_WORDS = 1 << 17
EPOCHS = 6
FILTERS = 8
DIMENSIONS = 8
#: Buckets of fewer training texts are unknown words.
LEAST_TEXTS = 3
#: Steps of a logit, by which calibration counts.
STEPS = 256
WIDTHS = (1, 2, 3)
CHUNK_BYTES = 4 << 20
#: Bits that tell rows without a label apart before their texts are read: rows of 4 KB for a broadcast, 4 MB in all.
SIEVE_BITS = 1 << 25


@dataclass
class ConvModel:
    """Weights of a trained model, a few MB. ``known`` maps buckets to rows of ``embed``; row 0 is all zeros."""

    known: np.ndarray
    embed: np.ndarray
    filters: list[np.ndarray]  # per width: (width, dimensions, filters)
    biases: list[np.ndarray]
    out: np.ndarray
    offset: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -40, 40)))


def word_buckets(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and the number of words per text; words are those of ``tokenise``."""
    words, n_words = tokenise(texts)
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words.dictionary.to_pylist()), np.int32, len(words.dictionary))
    return own[words.indices.to_numpy()], n_words


def _laid_out(rows: np.ndarray, counts: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all texts with ``pad`` zeros after each, and where each text begins (and the end)."""
    counts = np.asarray(counts, np.int64)
    bounds = np.append(0, np.cumsum(counts + pad))
    laid = np.zeros(bounds[-1], np.int64)
    laid[np.arange(len(rows)) + np.repeat(np.arange(len(counts)) * pad, counts)] = rows
    return laid, bounds


def _logits(model: ConvModel, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One logit per text. Every text has a pad, so that an empty one is scored too."""
    pad = max(WIDTHS)
    laid, bounds = _laid_out(rows, counts, pad)
    x = model.embed[laid]
    total = np.full(len(counts), model.offset, np.float64)
    at = 0
    for w, bias in zip(model.filters, model.biases, strict=True):
        y = _convolved(x, w) + bias
        # The windows that begin at a text's words and at the place behind them: none of these reaches the next text.
        edges = np.stack([bounds[:-1], bounds[1:] - pad + 1], axis=1).ravel()
        top = np.maximum(np.maximum.reduceat(y, edges, axis=0)[::2], 0) if len(counts) else y[:0]
        total += top @ model.out[at : at + len(bias)]
        at += len(bias)
    return total


def _convolved(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Filters over the windows that begin at each place; the last places are followed by zeros."""
    y = x @ w[0]
    for k in range(1, len(w)):
        y[:-k] += x[k:] @ w[k]
    return y


def _start(counts: pa.Table, prior: float, buckets: int, rng: np.random.Generator) -> tuple[np.ndarray, dict]:
    """Rows of the known buckets and the weights before training.

    Unknown words are all zeros, so that they move no filter. The first dimension starts as the log-odds of a word's
    texts and is trained on with the others.
    """
    kept, n, toxic = (counts[c].to_numpy() for c in ("bucket", "n", "toxic"))
    known = np.zeros(buckets, np.int32)
    known[kept] = np.arange(1, len(kept) + 1)
    odds = np.log((toxic + prior) / (n - toxic + 1 - prior)) - np.log(prior / (1 - prior))
    embed = rng.normal(0, 0.05, (len(kept) + 1, DIMENSIONS))
    embed[1:, 0] = odds / 2
    embed[0] = 0
    params = {"embed": embed, "out": np.full(FILTERS * len(WIDTHS), 0.3), "offset": np.array([np.log(prior / (1 - prior))])}
    for k, width in enumerate(WIDTHS):
        params[f"w{k}"], params[f"b{k}"] = rng.normal(0, 0.1, (width, DIMENSIONS, FILTERS)), np.full(FILTERS, -0.1)
        params[f"w{k}"][0, 0] += 0.5
    return known, params


def _steps(texts: list[np.ndarray], order: np.ndarray) -> Iterator[np.ndarray]:
    """``order`` in runs of at most ``STEP_TEXTS`` texts and about ``STEP_WORDS`` words."""
    held, words = [], 0
    for i in order:
        if held and (len(held) == STEP_TEXTS or words + len(texts[i]) > STEP_WORDS):
            yield np.array(held)
            held, words = [], 0
        held.append(i)
        words += len(texts[i])
    if held:
        yield np.array(held)


def _epoch(params: dict, texts: list[np.ndarray], labels: np.ndarray, rate: float, rng: np.random.Generator) -> tuple[np.ndarray, dict]:
    """One epoch over a part: the rows of ``embed`` that its words have, and the weights after it, ``embed`` cut to these rows."""
    own = np.unique(np.concatenate([np.zeros(1, np.int64), *texts]))
    texts = [np.searchsorted(own, t) for t in texts]
    params = {k: (v[own] if k == "embed" else v).astype(np.float64) for k, v in params.items()}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    for step, some in enumerate(_steps(texts, rng.permutation(len(texts))), 1):
        grads = _gradients(params, [texts[i] for i in some], labels[some], FILTERS)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        params["embed"][0] = 0
    return own, params


def _small(params: dict) -> list[str]:
    return sorted(k for k in params if k != "embed")


def _trained_rows(own: np.ndarray, before: dict, params: dict, n: int) -> pa.RecordBatch:
    """A part's weights as rows of ``DIMENSIONS`` numbers: the embeddings it changed by row, the others behind -1 downwards."""
    flat = np.concatenate([params[k].ravel() for k in _small(params)])
    flat = np.append(flat, np.zeros(-len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)
    moved = np.flatnonzero((params["embed"] != before["embed"][own]).any(axis=1))
    place = np.concatenate([own[moved], -1 - np.arange(len(flat))])
    values = np.concatenate([params["embed"][moved], flat]).astype(np.float32)
    return pa.RecordBatch.from_pydict({"place": place, "n": np.full(len(place), n), **{f"v{d}": values[:, d] for d in range(DIMENSIONS)}})


def _averaged(params: dict, found: pa.Table, held: np.ndarray) -> dict:
    """``params`` with the averages over the parts; a part that holds a word and left it alone counts with the weights before.

    ``held`` has per row the texts of the parts that hold its word. Words of no part keep their weights.
    """
    place, n = found["place"].to_numpy(), found["n"].to_numpy()
    sums = np.stack([found[f"v{d}"].to_numpy() for d in range(DIMENSIONS)], axis=1)
    word = place > 0
    embed = np.where((held > 0)[:, None], params["embed"].astype(np.float32), params["embed"]).astype(np.float64)
    at, whole = place[word], held[place[word]][:, None]
    embed[at] = (sums[word] + (whole - n[word][:, None]) * embed[at]) / whole
    flat = (sums[~word] / n[~word][:, None])[np.argsort(-place[~word])].ravel()
    out, at = {"embed": embed}, 0
    for k in _small(params):
        out[k] = flat[at : at + params[k].size].reshape(params[k].shape)
        at += params[k].size
    return out


def _over_parts(rows: DataFrame, function: Callable[[int, list[np.ndarray], list[float]], pa.RecordBatch], schema: str) -> DataFrame:
    """``function(part, texts, labels)`` of every part of ``rows``, which is sorted by parts; a long one is cut in two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, texts, labels, words = None, [], [], 0
        for batch in batches:
            for p, y, t in zip(batch["part"].to_pylist(), batch["label"].to_pylist(), batch["words"]):
                if texts and (p != part or words > PART_WORDS):
                    yield function(part, texts, labels)
                    texts, labels, words = [], [], 0
                part = p
                texts.append(np.array(t.values, np.int32))
                labels.append(y)
                words += len(texts[-1])
        if texts:
            yield function(part, texts, labels)

    bound_batches(rows.sparkSession)
    return rows.select("part", "label", "words").mapInArrow(run, schema)


def _held(rows: DataFrame, known: np.ndarray, size: int) -> np.ndarray:
    """Per row of ``embed`` the texts of the parts that hold its word; the same in every epoch."""

    def words(part: int, texts: list[np.ndarray], labels: list[float]) -> pa.RecordBatch:
        own = np.unique(known[np.concatenate(texts)]).astype(np.int64)
        return pa.RecordBatch.from_pydict({"place": own, "n": np.full(len(own), len(texts))})

    with shuffles_dropped(rows.sparkSession):
        found = _over_parts(rows, words, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(size, np.int64)
    held[found["place"].to_numpy()] = found["n"].to_numpy()
    held[0] = 0
    return held


def _train_epoch(rows: DataFrame, known: np.ndarray, params: dict, held: np.ndarray, epoch: int, seed: int) -> dict:
    """One epoch of every part, side by side, and the average of their weights by rows."""
    rate = 0.02 / (1 + epoch)

    def trained(part: int, texts: list[np.ndarray], labels: list[float]) -> pa.RecordBatch:
        rng = np.random.default_rng([seed, epoch, part])
        own, after = _epoch(params, [known[t].astype(np.int64) for t in texts], np.array(labels), rate, rng)
        return _trained_rows(own, params, after, len(texts))

    names = [f"v{d}" for d in range(DIMENSIONS)]
    each = _over_parts(rows, trained, "place long, n long, " + ", ".join(f"{v} float" for v in names))
    sums = each.groupBy("place").agg(F.sum("n").alias("n"), *[F.sum(F.col(v).cast("double") * F.col("n")).alias(v) for v in names])
    with shuffles_dropped(rows.sparkSession):
        return _averaged(params, sums.toArrow(), held)


def _constant(n: int, toxic: float, buckets: int) -> ConvModel:
    """Without both labels there is nothing to learn: every text gets the smoothed share of label 1."""
    p = (toxic + 0.1) / (n + 1)
    zero = [np.zeros((w, 1, 1), np.float32) for w in WIDTHS]
    return ConvModel(
        np.zeros(buckets, np.int32), np.zeros((1, 1), np.float32), zero,
        [np.zeros(1, np.float32) for _ in WIDTHS], np.zeros(len(WIDTHS)), float(np.log(p / (1 - p))),
    )


def _gradients(params: dict, texts: list[np.ndarray], labels: np.ndarray, filters: int) -> dict:
    pad = max(WIDTHS)
    laid, bounds = _laid_out(np.concatenate(texts), np.array([len(t) for t in texts]), pad)
    x = params["embed"][laid]
    tops, places, at = [], [], 0
    for k in range(len(WIDTHS)):
        y = _convolved(x, params[f"w{k}"]) + params[f"b{k}"]
        best = np.stack([y[a : b - pad + 1].argmax(axis=0) + a for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        places.append(best)
        tops.append(np.take_along_axis(y, best, axis=0))
    top = np.maximum(np.concatenate(tops, axis=1), 0)
    logits = top @ params["out"] + params["offset"][0]
    slope = (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels) / len(labels)
    grads = {"out": top.T @ slope + 1e-4 * params["out"], "offset": np.array([slope.sum()])}
    grads["embed"] = np.zeros_like(params["embed"])
    for k, width in enumerate(WIDTHS):
        own = slope[:, None] * params["out"][at : at + filters] * (tops[k] > 0)
        at += filters
        grads[f"b{k}"] = own.sum(axis=0)
        grad = np.zeros_like(params[f"w{k}"])
        for j in range(width):
            there = np.minimum(places[k] + j, len(laid) - 1)
            grad[j] = np.einsum("nf,nfd->df", own, x[there])
            flow = own[:, :, None] * params[f"w{k}"][j].T[None]
            np.add.at(grads["embed"], laid[there].ravel(), flow.reshape(-1, flow.shape[2]))
        grads[f"w{k}"] = grad
    return grads


def _calibrate(model: ConvModel, logits: DataFrame) -> None:
    """Logistic scale and shift over ``(logit, label, lang)``, then the threshold of the best F1 per language.

    All rows are counted by steps of their logit, so what reaches the driver does not grow with them.
    """
    clipped = F.greatest(F.least("logit", F.lit(40.0)), F.lit(-40.0))
    own = logits.select(F.coalesce("lang", F.lit("")).alias("lang"), "label", "logit", F.floor(clipped * STEPS).alias("step"))
    added = [F.sum(c).alias(c) for c in ("n", "hits", "sum")] + [F.min("low").alias("low"), F.max("high").alias("high")]
    steps = own.select("lang", "step", F.lit(1).alias("n"), F.col("label").alias("hits"), *[F.col("logit").alias(c) for c in ("sum", "low", "high")])
    steps = written(steps.groupBy("lang", "step").agg(*added), "steps")
    alike = steps.groupBy("step").agg(*added)
    table = alike.orderBy("step").toArrow()
    n, hits, total = (table[c].to_numpy().astype(float) for c in ("n", "hits", "sum"))
    if n.sum() >= 20 and 0 < hits.sum() < n.sum():
        a, b = _fitted(total / n, n, hits)
        if np.isfinite(a) and a > 0.05:
            model.scale, model.shift = float(min(a, 20)), float(np.clip(b, -40, 40))
    for row in _best_thresholds(alike.withColumn("lang", F.lit("")), model, 1):
        model.threshold = row["threshold"]
    model.thresholds = {row["lang"]: row["threshold"] for row in _best_thresholds(steps, model, 10)}


def _fitted(logits: np.ndarray, n: np.ndarray, hits: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the least logistic loss, by Newton steps that are halved until the loss falls."""

    def loss(at: np.ndarray) -> float:
        z = at[0] * logits + at[1]
        return float((n * np.logaddexp(0, z) - hits * z).sum() + 5e-3 * ((at[0] - 1) ** 2 + at[1] ** 2))

    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at[0] * logits + at[1], -40, 40)))
        w = n * (p * (1 - p) + 1e-6)
        g = np.array([((n * p - hits) * logits).sum() + 1e-2 * (at[0] - 1), (n * p - hits).sum() + 1e-2 * at[1]])
        h = np.array([[(w * logits**2).sum() + 1e-2, (w * logits).sum()], [(w * logits).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        while loss(at - step) > loss(at) and np.abs(step).sum() >= 1e-8:
            step = step / 2
        at = at - step
        if np.abs(step).sum() < 1e-8:
            break
    return float(at[0]), float(at[1])


def _best_thresholds(steps: DataFrame, model: ConvModel, least: int) -> list:
    """Per language with ``least`` texts of label 1: the middle of the gap between steps that gives the best F1."""

    def probability(logit: str) -> Column:
        return 1 / (1 + F.exp(-F.greatest(F.least(F.col(logit) * model.scale + model.shift, F.lit(40.0)), F.lit(-40.0))))

    falling = Window.partitionBy("lang").orderBy(F.desc("step"))
    above = falling.rowsBetween(Window.unboundedPreceding, 0)
    all_hits = F.sum("hits").over(Window.partitionBy("lang"))
    f1 = 2 * F.sum("hits").over(above) / (F.sum("n").over(above) + all_hits)
    gap = (probability("low") + F.lead(probability("high"), 1, 0.0).over(falling)) / 2
    rows = steps.select("lang", "step", f1.alias("f1"), gap.alias("gap"), all_hits.alias("hits")).filter(F.col("hits") >= least)
    return rows.groupBy("lang").agg(F.max_by("gap", F.struct("f1", "step")).alias("threshold")).collect()


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    language: str = "lang",
    buckets: int = BUCKETS,
    seed: int = 7,
) -> ConvModel:
    """Fit on all labelled rows, whole texts; a fifth of them, by a hash of their id, calibrates instead.

    Rows with a NULL label or id are not used; if an id has several labels the greatest counts. The rows' words are written
    once, each part's next to each other.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg(F.max(label).cast("double").alias("_label"))
    )
    chosen = written(chosen, "labels")
    kept = [F.col(doc_id).alias("_id"), F.col(language).cast("string").alias("_lang"), F.col(text).alias("_text")]
    rows = _sifted(docs.select(*kept), chosen)
    kind = rows.schema["_id"].dataType.simpleString()

    def hashed(table: pa.Table) -> pa.Table:
        words, counts = word_buckets(table["_text"].combine_chunks(), buckets)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(words))
        return pa.table({"_id": table["_id"], "lang": table["_lang"], "words": lists})

    # Texts become words where they are read; only words meet the labels, by the same plan whatever the size.
    words = map_arrow(rows, hashed, f"_id {kind}, lang string, words array<int>", CHUNK_BYTES).join(chosen.hint("merge"), "_id")
    found = written(words.select(F.xxhash64(F.lit(seed), "_id").alias("place"), F.col("_label").alias("label"), "lang", "words"), "words")
    checks = F.pmod(F.col("place"), F.lit(5)) == 0
    learned = found.filter(~checks)
    n, toxic, low, high = learned.agg(F.count(F.lit(1)), F.sum("label"), F.min("label"), F.max("label")).first()
    if not n or low == high:
        return _constant(*found.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first(), buckets)
    counts = _bucket_counts(learned, buckets).filter(F.col("n") >= LEAST_TEXTS).orderBy("bucket").toArrow()
    known, params = _start(counts, toxic / n, buckets, np.random.default_rng(seed))
    parts = -(-n // PART_ROWS)
    dealt = learned.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int"))
    dealt = written(dealt.repartitionByRange(parts, "part").sortWithinPartitions("part", "place", "words"), "parts")
    held = _held(dealt, known, len(params["embed"]))
    for epoch in range(EPOCHS):
        params = _train_epoch(dealt, known, params, held, epoch, seed)
    model = ConvModel(
        known, params["embed"].astype(np.float32), [params[f"w{k}"].astype(np.float32) for k in range(len(WIDTHS))],
        [params[f"b{k}"].astype(np.float32) for k in range(len(WIDTHS))], params["out"], float(params["offset"][0]),
    )

    def scored(table: pa.Table) -> pa.Table:
        lists = table["words"].combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        logits = _logits(model, model.known[lists.flatten().to_numpy()], sizes)
        return pa.table({"logit": logits, "label": table["label"], "lang": table["lang"]})

    checked = found.filter(checks).select("label", "lang", "words")
    _calibrate(model, written(map_arrow(checked, scored, "logit double, label double, lang string", CHUNK_BYTES), "logits"))
    return model


def _sifted(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` without most of those that have no label: ids whose bit no label has. The join by id decides about the rest.

    The bits take the same few MB however many labels there are.
    """
    if rows.schema["_id"].dataType != chosen.schema["_id"].dataType:  # equal values of two types have different hashes
        return rows
    bit = F.pmod(F.xxhash64("_id"), F.lit(SIEVE_BITS))
    bits = chosen.select(bit.alias("bit")).select(F.bitmap_bucket_number("bit").alias("_bucket"), F.bitmap_bit_position("bit").alias("at"))
    bits = bits.groupBy("_bucket").agg(F.bitmap_construct_agg("at").alias("_bits"))
    position = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = F.getbit(byte, (position % 8).cast("int")) == 1
    return rows.join(F.broadcast(bits), (F.bitmap_bucket_number(bit) == F.col("_bucket")) & known, "left_semi")


def _bucket_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, n, toxic)``: the texts that hold a bucket and those of them with label 1, added up per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, toxic = np.zeros(buckets, np.int64), np.zeros(buckets)
        for batch in batches:
            for y, t in zip(batch["label"].to_pylist(), batch["words"]):
                own = np.unique(np.asarray(t.values))
                n[own] += 1
                toxic[own] += y
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": own, "n": n[own], "toxic": toxic[own]})

    bound_batches(rows.sparkSession)
    each = rows.select("label", "words").mapInArrow(count, "bucket long, n long, toxic double")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def score(
    docs: DataFrame, model: ConvModel, doc_id: str = "doc_id", text: str = "text", language: str = "lang"
) -> DataFrame:
    """``(id, score, threshold, flagged)`` per row; whole texts, NULL as the empty text.

    ``threshold`` is that of the row's language, or of all languages where it has none. NULL ids and rows that
    repeat keep their rows; extra columns are not read.
    """
    kept = [F.col(doc_id).alias("id"), F.col(language).cast("string").alias("lang"), F.col(text).alias("text")]
    rows = docs.select(*kept)
    kind = rows.schema["id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        words, counts = word_buckets(table["text"].combine_chunks())
        p = model.probability(_logits(model, model.known[words], counts))
        limits = np.array([model.thresholds.get(x or "", model.threshold) for x in table["lang"].to_pylist()])
        return pa.table(
            {"id": table["id"], "score": pa.array(p), "threshold": pa.array(limits), "flagged": pa.array(p >= limits)}
        )

    return map_arrow(rows, run, f"id {kind}, score double, threshold double, flagged boolean", CHUNK_BYTES)
