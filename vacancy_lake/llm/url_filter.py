"""URL verdicts: rules by host and path, and a character language-model ratio for what no rule decides.

Rules name a host and the start of a path (`example.org/en/1`). A rule fits its host and all subdomains of it; the longest
rule that fits decides. The URLs that rules decide are the examples of two variable-order Markov models of characters, one
of accepted, one of rejected URLs. Transitions (context, next character) of all orders are counted over all examples, by
task before the shuffle. A transition stays in a model where it makes up at least SHARE of the characters of its class, so
a model has at most 1 / SHARE transitions an order, whatever the input: that bound lets it be sent to the tasks. Orders
are interpolated (Witten-Bell) from the uniform distribution upwards, a context that was not kept leaves it to the shorter
one, so the probabilities of what can follow a context add up to one.

The score of a URL is the difference of its two log-likelihoods divided by its length. A fifth of the examples, chosen by
a hash of the URL, is kept out of the counts; a logistic curve fitted to their scores, both classes weighing the same,
turns a score into the probability of acceptance. Its counts are taken over score bins, so they are bounded too.

Defined results: a null URL, or one without `://`, has an empty host and path and no rule; its text (null: empty) is judged
by the models like any other. Without examples of both classes nothing is known and what no rule decides is allowed, with
score 0.5. Rows repeat as they come; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Longest context, in characters.
ORDER = 5
#: Least share of the characters of its class that a transition makes up; 1 / SHARE bounds each order of a model.
SHARE = 1 / 50_000
#: Transitions seen less often than this are noise at any size.
LEAST = 2
#: Held-out scores are counted in bins of this width, between -LIMIT and LIMIT (beyond: in the outermost).
BIN, LIMIT = 0.005, 40.0

_SYMBOLS = 0x110000 + 1  # code points and the end
_END, _START = 0x110000, 0x110001
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host, then the start of the path from its slash on

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, start = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def with_rule(df: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """`df` with host, path, rule (text of the longest that fits, of equal ones the smaller text) and ruled (its verdict)."""
    df = df.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, r.text) if rule is None else rule.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return df.withColumns({"rule": none if rule is None else rule, "ruled": none if verdict is None else verdict})


# --- contexts ----------------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _symbols(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All characters and ends of texts, each text behind ORDER start marks; and the places of characters and ends."""
    codes = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    pad, end = np.full(ORDER, _START, np.uint32), np.array([_END], np.uint32)
    flat = np.concatenate([part for c in codes for part in (pad, c, end)] or [pad[:0]]).astype(np.uint64)
    return flat, np.flatnonzero(flat != _START)


def _contexts(flat: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """For each order from 0: hashes of the contexts of the places `at`."""
    total = np.zeros(len(at), np.uint64)
    for order in range(ORDER + 1):
        if order:
            total = total + (flat[at - order] + np.uint64(1)) * np.uint64(pow(int(_FACTOR), order, 1 << 64))
        yield _mixed(total + np.uint64(order + 1))


def _transition(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return _mixed(context ^ ((symbol + np.uint64(1)) * _FACTOR))


# --- models ------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class CharModel:
    """Kept transitions and contexts of one class, sorted by hash; a context counts what was kept of it."""

    transitions: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray

    @staticmethod
    def of(context: np.ndarray, symbol: np.ndarray, counts: np.ndarray) -> CharModel:
        key = _transition(context, symbol)
        order = np.argsort(key)
        known, place = np.unique(context, return_inverse=True)
        return CharModel(key[order], counts[order].astype(float), known,
                         np.bincount(place, counts, len(known)), np.bincount(place, minlength=len(known)).astype(float))

    def log_probabilities(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each symbol after what stands before it."""
        p = np.full(len(at), 1.0 / _SYMBOLS)
        for context in _contexts(flat, at):
            total, kinds = _found(self.contexts, (self.totals, self.kinds), context)
            seen, = _found(self.transitions, (self.counts,), _transition(context, flat[at]))
            p = np.where(total > 0, (seen + kinds * p) / np.maximum(total + kinds, 1), p)
        return np.log(p)


def _found(keys: np.ndarray, values: tuple[np.ndarray, ...], wanted: np.ndarray) -> list[np.ndarray]:
    """Values at the wanted keys, 0 where a key is unknown."""
    if not len(keys):
        return [np.zeros(len(wanted))] * len(values)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[place] == wanted
    return [np.where(hit, v[place], 0.0) for v in values]


@dataclass(frozen=True)
class UrlModel:
    """Models of accepted and rejected URLs, and the curve slope * score + shift from score to log odds."""

    accepted: CharModel
    rejected: CharModel
    slope: float = 1.0
    shift: float = 0.0

    def ratios(self, texts: Sequence[str | None]) -> np.ndarray:
        """Difference of log-likelihoods, accepted less rejected, per character (the end counts as one)."""
        flat, at = _symbols(texts)
        ends = np.flatnonzero(flat[at] == _END) + 1
        if not len(ends):
            return np.zeros(0)
        starts = np.concatenate([[0], ends[:-1]])
        gap = self.accepted.log_probabilities(flat, at) - self.rejected.log_probabilities(flat, at)
        return np.add.reduceat(gap, starts) / (ends - starts)


def _slices(batch: pa.RecordBatch, rows: int = 2048, characters: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of a batch of bounded length; a single longer text makes a run of its own."""
    at, size = 0, 0
    for i, text in enumerate(batch.column(batch.num_columns - 1)):
        size += len(text.as_py() or "") + ORDER + 1
        if i + 1 - at >= rows or size >= characters:
            yield batch.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def transition_counts(examples: DataFrame) -> DataFrame:
    """(label, context, symbol, n) of examples (label int, url), counted by run of rows, then by shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                labels, urls = np.array(part.column(0).to_pylist()), part.column(1).to_pylist()
                for label in np.unique(labels):
                    flat, at = _symbols([u for u, own in zip(urls, labels == label) if own])
                    symbol = np.tile(flat[at], ORDER + 1)
                    context = np.concatenate(list(_contexts(flat, at)))
                    _, first, n = np.unique(_transition(context, symbol), return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), label, np.int32)), pa.array(context[first].astype(np.int64)),
                         pa.array(symbol[first].astype(np.int32)), pa.array(n.astype(np.int64))], ["label", "context", "symbol", "n"])

    parts = examples.select("label", "url").mapInArrow(run, "label int, context long, symbol int, n long")
    return parts.groupBy("label", "context", "symbol").agg(F.sum("n").alias("n"))


def _ratio_column(df: DataFrame, model: UrlModel, columns: Sequence[str], url_col: str) -> DataFrame:
    """`columns` of `df` and `ratio` of its URLs; the model is sent to the tasks once."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns) + ", ratio double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                ratios = shared.value.ratios(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ratios, pa.float64())], [*columns, "ratio"])

    return df.select(*columns, F.col(url_col).alias("_url")).mapInArrow(run, schema)


def fit(examples: DataFrame, share: float = SHARE, least: int = LEAST) -> UrlModel | None:
    """Models and calibration from examples (label 1 accepted or 0 rejected, url); None without both classes."""
    examples = examples.select(F.col("label").cast("int").alias("label"), F.coalesce("url", F.lit("")).alias("url"))
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    counts = transition_counts(examples.where(~held))
    # Every order counts each character once, so the sum is (ORDER + 1) times the characters of a class.
    sizes = counts.groupBy("label").agg((F.sum("n") / (ORDER + 1)).alias("size"))
    kept = counts.join(F.broadcast(sizes), "label").where(F.col("n") >= F.greatest(F.lit(float(least)), F.col("size") * share))
    rows = kept.select("label", "context", "symbol", "n").toPandas()  # at most 2 * (ORDER + 1) / share rows

    def side(label: int) -> CharModel:
        own = rows[rows["label"] == label].sort_values(["context", "symbol"])
        return CharModel.of(own["context"].to_numpy(np.int64).astype(np.uint64), own["symbol"].to_numpy().astype(np.uint64),
                            own["n"].to_numpy(float))

    if rows["label"].nunique() < 2:
        return None
    model = UrlModel(side(1), side(0))
    scored = _ratio_column(examples.where(held), model, ["label"], "url")
    bin_ = F.round(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("ratio"))) / BIN).cast("int")
    bins = scored.groupBy("label", bin_.alias("bin")).agg(F.count("*").alias("n")).orderBy("label", "bin").toPandas()
    if bins["label"].nunique() < 2:
        return model
    weight = bins["n"] / bins.groupby("label")["n"].transform("sum")
    slope, shift = logistic_curve(bins["bin"].to_numpy() * BIN, bins["label"].to_numpy(float), weight.to_numpy())
    return UrlModel(model.accepted, model.rejected, slope, shift)


def logistic_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift of the logistic curve of least weighted loss (Newton); the ridge keeps separated classes finite."""
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)

    def loss(b):
        z = design @ b
        return float(weight @ (np.logaddexp(0, z) - y * z) + ridge * b @ b / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        slope = design.T @ (weight * (p - y)) + ridge * beta
        curve = design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge * np.eye(2)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def judge(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, score (probability of acceptance by the models) of every row."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_text"))
    ruled = with_rule(rows, rules, "_text")
    label = F.when(F.col("ruled") == "allow", 1).when(F.col("ruled") == "block", 0)
    model = fit(ruled.where(label.isNotNull()).select(label.alias("label"), F.col("_text").alias("url")))
    if model is None:
        scored = ruled.withColumn("score", F.lit(0.5))
    else:
        odds = F.col("ratio") * model.slope + model.shift
        scored = _ratio_column(ruled, model, ["_id", "host", "path", "rule", "ruled"], "_text").withColumn(
            "score", 1 / (1 + F.exp(-odds)))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return scored.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
