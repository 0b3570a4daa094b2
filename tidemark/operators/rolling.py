"""Rolling statistics over row frames by composition.

Spark evaluates a sliding frame by going over all its rows again for every row, so a 60-row frame
costs 60 updates per function. The frames here are multiples of each other, so each one is put
together from the shorter one at a few lags:

    5 rows  = the row and its 4 predecessors
    15 rows = the 5-row frame here, 5 and 10 rows ago
    60 rows = the 15-row frame here, 15, 30 and 45 rows ago

Count, mean, squared deviation and co-moment combine by the usual pairwise formulas, which are as
stable as a two-pass evaluation; maximum and minimum combine directly. Everything is `lag` and
arithmetic in generated code, and all lags share one partitioning and one sort.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

STATS = ("n", "mean", "m2", "max", "min")


def _sum(terms: list[str]) -> str:
    return " + ".join(f"coalesce({t}, 0)" for t in terms)


def _pick(fn: str, parts: list[str]) -> str:
    return f"{fn}({', '.join(parts)})" if len(parts) > 1 else parts[0]


@dataclass
class Rolling:
    """Rolling frames over `values` (name -> SQL expression) and `pairs` (name -> two values).

    Both inputs of a pair should be NULL together for its co-moment to be over complete pairs.
    Expressions are SQL text: a wide frame has hundreds of them, and parsing text is much cheaper
    than building the same trees call by call from Python.
    """

    partition: list[str]
    order: list[str]
    values: dict[str, str]
    pairs: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def series(self) -> str:
        return f"PARTITION BY {', '.join(self.partition)} ORDER BY {', '.join(self.order)}"

    def stat(self, name: str, stat: str, rows: int) -> str:
        return f"_{name}_{stat}_{rows}"

    def _names(self, rows: int) -> list[str]:
        names = [self.stat(v, s, rows) for v in self.values for s in STATS]
        return names + [self.stat(p, "c", rows) for p in self.pairs]

    def lags(self, columns: list[str], steps: list[int]) -> list[str]:
        """One lagged struct of the columns per step: `_ago<k>`."""
        here = ", ".join(columns)
        return [f"lag(struct({here}), {k}) OVER ({self.series}) AS _ago{k}" for k in steps]

    def base(self, df: DataFrame, rows: int) -> DataFrame:
        """Add the statistics of the shortest frame, from the row and its predecessors."""
        keep = df.columns
        inputs = [f"_in_{v}" for v in self.values]
        df = df.selectExpr("*", *[f"{e} AS _in_{v}" for v, e in self.values.items()])
        df = df.selectExpr("*", *self.lags(inputs, list(range(1, rows))))
        frame = {v: [f"_in_{v}", *[f"_ago{k}._in_{v}" for k in range(1, rows)]] for v in self.values}
        firsts = []
        for v, xs in frame.items():
            n = " + ".join(f"int({x} IS NOT NULL)" for x in xs)
            firsts += [
                f"{n} AS {self.stat(v, 'n', rows)}",
                f"try_divide({_sum(xs)}, {n}) AS {self.stat(v, 'mean', rows)}",
                f"{_pick('greatest', xs)} AS {self.stat(v, 'max', rows)}",
                f"{_pick('least', xs)} AS {self.stat(v, 'min', rows)}",
            ]
        df = df.selectExpr("*", *firsts)
        seconds = []
        for v, xs in frame.items():
            mean = self.stat(v, "mean", rows)
            seconds.append(f"{_sum([f'({x} - {mean}) * ({x} - {mean})' for x in xs])} AS {self.stat(v, 'm2', rows)}")
        for p, (x, y) in self.pairs.items():
            mx, my = self.stat(x, "mean", rows), self.stat(y, "mean", rows)
            terms = [f"({a} - {mx}) * ({b} - {my})" for a, b in zip(frame[x], frame[y])]
            seconds.append(f"{_sum(terms)} AS {self.stat(p, 'c', rows)}")
        return df.selectExpr("*", *seconds).select(*keep, *self._names(rows))

    def extend(self, df: DataFrame, short: int, longs: list[int]) -> DataFrame:
        """Add the statistics of longer frames, each a multiple of `short` rows already present."""
        steps = sorted({k for rows in longs for k in range(short, rows, short)})
        keep = df.columns
        df = df.selectExpr("*", *self.lags(self._names(short), steps))
        means, moments = [], []
        for rows in longs:
            for v in self.values:
                ns, ms = self._parts(v, "n", short, rows), self._parts(v, "mean", short, rows)
                n = _sum(ns)
                means += [
                    f"{n} AS {self.stat(v, 'n', rows)}",
                    f"try_divide({_sum([f'{a} * {b}' for a, b in zip(ns, ms)])}, {n}) AS {self.stat(v, 'mean', rows)}",
                    f"{_pick('greatest', self._parts(v, 'max', short, rows))} AS {self.stat(v, 'max', rows)}",
                    f"{_pick('least', self._parts(v, 'min', short, rows))} AS {self.stat(v, 'min', rows)}",
                ]
                moments.append(self._moved(v, "m2", v, v, short, rows))
            moments += [self._moved(p, "c", x, y, short, rows) for p, (x, y) in self.pairs.items()]
        df = df.selectExpr("*", *means).selectExpr("*", *moments)
        return df.select(*keep, *[n for rows in longs for n in self._names(rows)])

    def _parts(self, name: str, stat: str, short: int, rows: int) -> list[str]:
        column = self.stat(name, stat, short)
        return [column, *[f"_ago{k}.{column}" for k in range(short, rows, short)]]

    def _moved(self, name: str, stat: str, x: str, y: str, short: int, rows: int) -> str:
        """Second moment of the long frame: those of its parts, moved to the common mean."""
        mx, my = self.stat(x, "mean", rows), self.stat(y, "mean", rows)
        own, ns = self._parts(name, stat, short, rows), self._parts(x, "n", short, rows)
        xs, ys = self._parts(x, "mean", short, rows), self._parts(y, "mean", short, rows)
        terms = [f"{o} + {n} * ({a} - {mx}) * ({b} - {my})" for o, n, a, b in zip(own, ns, xs, ys)]
        return f"{_sum(terms)} AS {self.stat(name, stat, rows)}"

    def _varies(self, v: str, rows: int) -> str:
        # Exact test for a constant frame: rounding must not leave a tiny deviation behind.
        return f"{self.stat(v, 'max', rows)} > {self.stat(v, 'min', rows)}"

    def std(self, v: str, rows: int, population: bool = False) -> str:
        """Deviation of the frame; 0 for fewer than two values and for a constant frame."""
        degrees = self.stat(v, "n", rows) + ("" if population else " - 1")
        spread = f"sqrt(try_divide({self.stat(v, 'm2', rows)}, {degrees}))"
        return f"CASE WHEN {self._varies(v, rows)} THEN {spread} ELSE 0D END"

    def zscore(self, v: str, std: str, rows: int, min_rows: int) -> str:
        """(value - mean) / std of the frame; 0 below `min_rows` values or without deviation."""
        known = f"{self.stat(v, 'n', rows)} >= {min_rows} AND {std} > 0"
        return f"CASE WHEN {known} THEN try_divide({v} - {self.stat(v, 'mean', rows)}, {std}) ELSE 0D END"

    def correlation(self, p: str, rows: int, min_pairs: int) -> str:
        """Pearson correlation of a pair; 0 below `min_pairs` pairs or for a constant input."""
        x, y = self.pairs[p]
        spread = f"(sqrt({self.stat(x, 'm2', rows)}) * sqrt({self.stat(y, 'm2', rows)}))"
        known = f"{self.stat(x, 'n', rows)} >= {min_pairs} AND {self._varies(x, rows)} AND {self._varies(y, rows)}"
        value = f"coalesce(try_divide({self.stat(p, 'c', rows)}, {spread}), 0D)"
        return f"CASE WHEN {known} THEN {value} ELSE 0D END"
