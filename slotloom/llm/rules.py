"""Quality rules: text statistics, fixed base rules, and a decision list learnt from labelled statistics.

The list is learnt by sequential covering. A rule is a conjunction of thresholds on statistics. It grows,
one condition at a time, on two thirds of the labelled rows by information gain for the low class; it is
pruned from its end on the other third; rows that it covers are taken out, and the next rule grows from the rest. A
rule is kept only if at least ``precision`` of what it covers, on both parts, is of low quality, so clean
texts stay. The list leaves as one ordered Spark conditional expression, which runs in the JVM.

Statistics are counted over every whole text. Only the fit reads a sample: at most ``FIT_ROWS`` labelled
rows, chosen by hash. Defined results: a null or empty text has no words and fails the base rules; repeated
rows are judged alike; a document with several labels counts as low if any label says so; without
labels of both classes the list is empty and the base rules alone decide.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotloom.llm.words import Slice, mix, slices, windows

# The most labelled rows that a fit reads.
FIT_ROWS = 20_000
# The rows that a worker takes at once.
FEW_ROWS = 512
REPEAT_WINDOW = 8
LEAST_WORDS = 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_STEP = 0x9E3779B97F4A7C55


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _dup_lines(part: Slice) -> np.ndarray:
    out = np.zeros(part.high - part.low, dtype=np.int64)
    breaks = np.flatnonzero(part.data == 0x0A)
    for row, (low, high) in enumerate(zip(part.offsets[:-1], part.offsets[1:])):
        cuts = breaks[np.searchsorted(breaks, low):np.searchsorted(breaks, high)]
        if not len(cuts):
            continue
        begins, ends = np.append(low, cuts + 1), np.append(cuts, high)
        has_word = np.searchsorted(part.ends, begins, "right") < np.searchsorted(part.starts, ends, "left")
        lines = [part.data[a:b].tobytes() for a, b in zip(begins[has_word], ends[has_word])]
        out[row] = len(lines) - len(set(lines))
    return out


def _repeat_words(part: Slice) -> np.ndarray:
    """Words in windows that start at two or more places of their text."""
    delta = np.zeros(len(part.starts) + 1, dtype=np.int32)
    starts = np.flatnonzero(part.room(REPEAT_WINDOW))
    if len(starts):
        rows = part.row_of_word()[starts].astype(np.uint64)
        seen = mix(windows(part.hashes(), REPEAT_WINDOW, _STEP)[starts] + mix(rows + np.uint64(1)))
        order = np.argsort(seen, kind="stable")
        same = seen[order][1:] == seen[order][:-1]
        again = starts[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        delta[again] += 1
        delta[again + REPEAT_WINDOW] -= 1
    return _per_text(np.cumsum(delta[:-1]) > 0, part.first)


def _counts(texts: pa.Array) -> list[pa.Array]:
    found: list[list[np.ndarray]] = [[] for _ in COUNTS]
    for part in slices(texts):
        inside = np.zeros(len(part.data) + 1, dtype=np.int8)
        inside[part.starts] += 1
        inside[part.ends] -= 1
        letters = (np.cumsum(inside[:-1]) > 0) & ((part.data & 0xC0) != 0x80)
        for into, counts in zip(found, (
            np.diff(part.first), _per_text(letters, part.offsets), _per_text(_SYMBOLS[part.data], part.offsets),
            _dup_lines(part), _repeat_words(part),
        )):
            into.append(counts)
    return [pa.array(np.concatenate(x).astype(np.int64)) if x else pa.array([], pa.int64()) for x in found]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row of ``docs`` as ``row`` (a struct of its columns), with its text's counts and ``base_failed``."""
    names = ["row", *COUNTS]

    def count(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, FEW_ROWS):
                rows = batch.column("row").slice(low, FEW_ROWS)
                yield pa.RecordBatch.from_arrays([rows, *_counts(pc.struct_field(rows, text))], names)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"row {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    return counted.withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))


def _measures() -> dict[str, Column]:
    """What rules may test. The base rules leave no text without words to them."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "n_dup_lines": F.col("n_dup_lines").cast("double"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction: (measure, "<=" or ">", threshold) each."""

    tests: tuple[tuple[str, str, float], ...]

    def covers(self, data: pd.DataFrame) -> np.ndarray:
        hit = np.ones(len(data), dtype=bool)
        for name, sign, bound in self.tests:
            values = data[name].to_numpy()
            hit &= values <= bound if sign == "<=" else values > bound
        return hit

    def column(self) -> Column:
        named = _measures()
        return reduce(lambda a, b: a & b, (
            named[n] <= F.lit(bound) if sign == "<=" else named[n] > F.lit(bound) for n, sign, bound in self.tests))


def _best_test(data: pd.DataFrame, low: np.ndarray, names: list[str]):
    """The threshold with the largest information gain for the low class among the given rows."""
    total_low, total = low.sum(), len(low)
    base = np.log2(total_low / total)
    best = (0.0, None)
    for name in names:
        values = data[name].to_numpy()
        order = np.argsort(values, kind="stable")
        v, lows = values[order], np.cumsum(low[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        bounds = (v[cut] + v[cut + 1]) / 2
        for sign, p, n in (("<=", lows[cut], cut + 1), (">", total_low - lows[cut], total - cut - 1)):
            gain = p * (np.log2(np.maximum(p, 1e-9) / n) - base)
            at = int(np.argmax(gain))
            if gain[at] > best[0] + 1e-9:
                best = (float(gain[at]), (name, sign, float(bounds[at])))
    return best[1]


def learn(data: pd.DataFrame, low: np.ndarray, precision: float = 0.97, least: int = 5, tests: int = 4, rules: int = 16) -> list[Rule]:
    """The decision list for rows of measures; ``low`` says which are of low quality.

    ``least`` is the fewest low rows that a rule must cover, ``tests`` the most conditions in a rule,
    ``rules`` the most rules. Rows are taken in the given order, so sort them for a repeatable list.
    """
    names, found = list(data.columns), []
    left = np.ones(len(data), dtype=bool)
    third = np.arange(len(data)) % 3 == 2
    while len(found) < rules:
        grow, prune = left & ~third, left & third
        if low[grow].sum() < least:
            break
        chosen, hit = [], grow.copy()
        while len(chosen) < tests and low[hit].sum() and not low[hit].all():
            test = _best_test(data[hit], low[hit], names)
            if test is None:
                break
            chosen.append(test)
            hit &= Rule((test,)).covers(data)

        def worth(n: int) -> float:
            covered = Rule(tuple(chosen[:n])).covers(data) & prune
            p = low[covered].sum()
            return (2 * p - covered.sum()) / max(1, covered.sum())

        if not chosen:
            break
        size = max(range(1, len(chosen) + 1), key=lambda n: (worth(n), -n))
        rule = Rule(tuple(chosen[:size]))
        covered = rule.covers(data) & left
        if low[covered].sum() < least or low[covered].mean() < precision:
            rule = Rule(tuple(chosen))  # the unpruned rule may still be pure enough
            covered = rule.covers(data) & left
        checked = covered & third
        if low[covered].sum() < least or low[covered].mean() < precision or (checked.any() and low[checked].mean() < precision):
            break
        found.append(rule)
        left &= ~covered
    return found


def expression(found: list[Rule]) -> Column:
    """Whether a row is kept: the first rule that holds rejects it, else it stays."""
    out = F
    for rule in found:
        out = out.when(rule.column(), F.lit(False))
    return out.otherwise(F.lit(True)) if found else F.lit(True)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality", most: int = FIT_ROWS, **settings) -> list[Rule]:
    """A decision list from at most about ``most`` labelled documents (quality 0 is low)."""
    labels = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(key).agg(F.min(quality).alias("_quality"))
    n = labels.count()
    if not n:
        return []
    share = min(1.0, most / n)
    chosen = labels.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # The sample's size is bounded, so it may be broadcast.
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(
        F.broadcast(chosen.withColumnRenamed(key, "_key")), "_key")
    rows = statistics(sample).where("not base_failed").select(
        F.col("row._quality").alias("quality"), F.xxhash64("row._key", "row.text").alias("order"),
        *[c.alias(n) for n, c in _measures().items()]).toPandas().sort_values(["order", "quality"], kind="stable")
    low = rows["quality"].to_numpy() == 0
    if not low.any() or low.all():
        return []
    return learn(rows[list(_measures())].reset_index(drop=True), low, **settings)


def judge(docs: DataFrame, found: list[Rule], text: str = "text") -> DataFrame:
    """``statistics`` with ``kept``."""
    return statistics(docs, text).withColumn("kept", ~F.col("base_failed") & expression(found))
