"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on the labelled sample, each on the gradient of the trees before it. Every path from a root to a
node is a rule, a conjunction of comparisons. Lasso logistic regression weighs the rules and leaves few; these are
compiled into one Spark column over the statistics, so scoring is a projection.

Learning takes about SAMPLE labelled rows at most, chosen by hash of their id; only their statistics reach the driver.
Labels other than 0 and 1 are ignored. Statistics are computed over whole texts in one pass.

Cases: a null or empty text has all statistics 0 and a score like any other. Without labels of both kinds the score is
the share of label 1, or 0.5 without any. Repeated rows are scored alike; ids and metadata are never inputs.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.llm.frames import map_rows, table, texts, utf8
from echowire.session import stored

#: Labelled rows that are learnt from, at most (in the mean over hashes).
SAMPLE = 20_000
#: Ids of labelled documents (8 bytes each) that may be broadcast.
BROADCAST_IDS = 1_000_000
TREES = 40
DEPTH = 3
BINS = 32
#: Weight of the lasso term.
LASSO = 0.002
THRESHOLD = 0.3

STATISTICS = (
    "log_bytes", "log_words", "word_length", "long_words", "short_words", "distinct_words", "top_word", "next_repeats",
    "letters", "upper", "digits", "marks", "signs", "bars", "line_words", "repeated_lines", "end_marks", "run_marks",
    "spoiled_words",
)

_SIGNS = frozenset(b"#$%&*@^~=+<>{}[]_\\")
_ENDS = frozenset(b".!?")
_CLASS = np.zeros(256, dtype=np.int64)  # 0 other, 1 lower or non-ASCII, 2 upper, 3 digit, 4 mark, 5 sign, 6 bar, 7 blank
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        1 if "a" <= _c <= "z" or _b >= 0x80 else 2 if "A" <= _c <= "Z" else 3 if "0" <= _c <= "9"
        else 6 if _c == "|" else 5 if _b in _SIGNS else 7 if _c in " \t\n\x0b\x0c\r" else 4 if 0x21 <= _b <= 0x7E else 0
    )
_SPOILING = np.isin(_CLASS, (3, 5, 6)) | (np.arange(256) == ord("!"))


def statistics(text: bytes) -> tuple[float, ...]:
    """The values named in STATISTICS."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n = len(words)
    data = np.frombuffer(text, np.uint8)
    kinds = np.zeros(8, dtype=np.int64)
    spoiled = runs = 0
    for at in range(0, len(data), 1 << 20):  # bounded memory for very long texts
        part = data[at : at + (1 << 20)]
        kind = _CLASS[part]
        kinds += np.bincount(kind, minlength=8)
        runs += int(((kind[1:] == kind[:-1]) & ((kind[1:] == 4) | (kind[1:] == 5))).sum())
        bad = _SPOILING[part]
        blank = kind == 7
        # a word is spoiled once for its first bad byte
        word_of = np.cumsum(blank)
        spoiled += len(np.unique(word_of[bad]))
    solid = max(1, int(kinds[:7].sum()))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        float(np.log1p(len(text))), float(np.log1p(n)), float(sizes.mean()), float((sizes > 12).mean()),
        float((sizes <= 3).mean()), len(counts) / n, max(counts.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        int(kinds[1] + kinds[2]) / solid, int(kinds[2]) / max(1, int(kinds[1] + kinds[2])), int(kinds[3]) / solid,
        int(kinds[4]) / solid, int(kinds[5]) / solid, int(kinds[6]) / solid, n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), sum(w[-1] in _ENDS for w in words) / n, runs / solid, spoiled / n,
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text."""

    def make():
        def run(batch: pa.RecordBatch) -> list:
            return [batch.column("doc_id"), *zip(*(statistics(t) for t in utf8(batch, "text")))]

        return run

    return map_rows(texts(docs), "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS), make)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, limit)


def _grow(x: np.ndarray, cut: list[np.ndarray], y: np.ndarray, rows: np.ndarray, depth: int, path: Rule, out: list, rng) -> list:
    """Grow a least-squares tree on y; collects the paths and returns its leaves (path, value)."""
    value = float(y[rows].mean())
    if depth == 0 or len(rows) < 40:
        return [(path, value)]
    best = None
    for f in rng.choice(x.shape[1], size=max(1, x.shape[1] // 2), replace=False):
        limits = cut[f]
        if not len(limits):
            continue
        bin_of = np.searchsorted(limits, x[rows, f], side="left")
        n = np.bincount(bin_of, minlength=len(limits) + 1)
        s = np.bincount(bin_of, weights=y[rows], minlength=len(limits) + 1)
        left_n, left_s = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
        right_n, right_s = len(rows) - left_n, s.sum() - left_s
        ok = (left_n >= 20) & (right_n >= 20)
        if not ok.any():
            continue
        gain = np.where(ok, left_s**2 / np.maximum(left_n, 1) + right_s**2 / np.maximum(right_n, 1), -np.inf)
        i = int(gain.argmax())
        if best is None or gain[i] > best[0]:
            best = (gain[i], int(f), float(limits[i]))
    if best is None or best[0] <= y[rows].sum() ** 2 / len(rows) + 1e-9:
        return [(path, value)]
    _, f, limit = best
    leaves = []
    for above in (False, True):
        side = rows[(x[rows, f] > limit) == above]
        longer = (*path, (f, above, limit))
        out.append(longer)
        leaves += _grow(x, cut, y, side, depth - 1, longer, out, rng)
    return leaves


def holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for f, above, limit in rule:
        ok &= (x[:, f] > limit) == above
    return ok


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Distinct tree paths of a boosted ensemble, on a fixed seed."""
    rng = np.random.default_rng(8)
    cut = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    cut = [c[c < x[:, f].max()] for f, c in enumerate(cut)]
    margin = np.zeros(len(y))
    paths: list[Rule] = []
    for _ in range(TREES):
        rows = rng.permutation(len(y))[: max(200, len(y) // 2)]
        gradient = y - 1 / (1 + np.exp(-margin))
        for path, value in _grow(x, cut, gradient, rows, DEPTH, (), paths, rng):
            margin += np.where(holds(x, path), value, 0.0)
    rules = {tuple(sorted(p)) for p in paths}
    return sorted(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, lasso: float = LASSO, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient; the intercept is not shrunk."""
    a = np.hstack([np.ones((len(z), 1)), z])
    w = np.zeros(a.shape[1])
    w[0] = np.log(y.mean() / (1 - y.mean()))
    ahead, momentum = w.copy(), 1.0
    v = np.full(a.shape[1], 1 / np.sqrt(a.shape[1]))
    for _ in range(20):  # largest eigenvalue by power iteration
        v = a.T @ (a @ v)
        top = np.linalg.norm(v)
        v /= top
    step = 3.6 * len(y) / top
    for _ in range(steps):
        grad = a.T @ (1 / (1 + np.exp(-(a @ ahead))) - y) / len(y)
        new = ahead - step * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * lasso, 0)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / after * (new - w)
        w, momentum = new, after
    return float(w[0]), w[1:]


class Model:
    """Rules with non-zero weights and an intercept, or a constant."""

    def __init__(self, intercept: float, rules: list[Rule], weights: list[float]):
        self.intercept, self.rules, self.weights = intercept, rules, weights

    def score(self) -> Column:
        """The score as a Spark column over the statistics."""
        margin = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            ok = None
            for f, above, limit in rule:
                column = F.col(STATISTICS[f])
                part = column > limit if above else column <= limit
                ok = part if ok is None else ok & part
            margin = margin + F.when(ok, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))), [], [])
    rules = tree_rules(x, y)
    z = np.stack([holds(x, r) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    intercept, weights = lasso_logistic(z, y)
    kept = np.flatnonzero(weights)
    return Model(intercept, [rules[i] for i in kept], [float(weights[i]) for i in kept])


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the labels of rows that are not held out."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("__label"))
    known = known.where(~held_out())
    rows = stats.join(known, "doc_id")
    share = min(1.0, sample / max(1, known.count()))
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    found = rows.select("__label", *STATISTICS).toPandas().sort_values(list(STATISTICS) + ["__label"])
    return fit(found[list(STATISTICS)].to_numpy(float), found["__label"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    stats = stored(with_statistics(docs), "statistics")
    score = train(stats, labels, sample).score()
    return stats.select(
        "doc_id", held_out().alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns.

    The model is fitted on the statistics of the labelled documents; its rules then run beside the text, so no text is
    shuffled for the decision.
    """
    known = stored(labels.where("doc_id IS NOT NULL").select("doc_id").distinct(), "labelled")
    if known.count() <= BROADCAST_IDS:  # then no text is shuffled to find the labelled documents
        known = F.broadcast(known)
    stats = stored(with_statistics(docs.join(known, "doc_id", "left_semi")), "labelled-statistics")
    score = train(stats, labels, sample).score()
    names = ", ".join(f"{s}: double" for s in STATISTICS)

    @F.pandas_udf(f"struct<{names}>")
    def stats_of(text):
        import pandas as pd

        return pd.DataFrame([statistics((t or "").encode()) for t in text], columns=list(STATISTICS), dtype=float)

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    marked = docs.select(row, stats_of("text").alias("__stats")).select("__row", "__stats.*")
    return marked.where(score >= threshold).select(*(F.col(f"__row.`{c}`").alias(c) for c in docs.columns))


def op8_rule_quality(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
