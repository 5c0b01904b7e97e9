"""Exact order statistics of several columns at once, as one lazy plan.

``order_statistics_sql`` finds the rows at given ranks (the cuts of NTILE, the
neighbours of a quantile) without sorting the table and without a job while the
plan is built.  It is SQL text, so that views can hold it; the functions that
take a DataFrame run the same text.

1. One aggregate sketches every column near the wanted ranks
   (``percentile_approx`` at each probability and a little to both sides) and the
   tie-break column as a whole.  The sketch only chooses where to cut; nothing
   below depends on its accuracy.
2. One pass counts the rows of every *cell*: the values between two neighbouring
   sketch points, and each sketch point itself, which is split by ranges of the
   tie-break, since a point may hold any share of the rows (half of all customers
   have one order).  Some thousand counts tell which cell holds each rank.
3. The rows of those cells alone (about one in ``GRID`` of the table each) are
   numbered, each cell by itself.

The table is read three times, by plans that share its exchanges; no task gets
more than a cell, and the driver gets no row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: Ranges of the tie-break column.
GRID = 256
#: Half the width of the sketched interval around a probability.
NEAR = 0.002
ACCURACY = 10_000
#: The type in which values are compared.  Whole numbers compare fastest: give
#: money in cents, or a decimal type where that is too small.
KIND = "bigint"


def below(points: str, n: int, value: str) -> str:
    """SQL: how many of at most ``n`` sorted points are below a value, by bisection."""
    steps = ", ".join(str(1 << i) for i in reversed(range(n.bit_length())))
    return (f"aggregate(array({steps}), 0, (a, s) -> IF(a + s <= size({points}) AND get({points}, a + s - 1) < {value}, a + s, a))")


def order_statistics_sql(src: str, columns: dict[str, str], probs: Sequence[float], ranks: Sequence[str],
                         tie: str | None = None, kind: str = KIND, tie_kind: str = "bigint") -> str:
    """CTEs, the last of which is ``at_ranks(m)``: one row, a map of column name
    to struct(n, at): the number of rows and the array, by rank, of struct(value,
    tie).

    ``src`` is a relation's name; ``columns`` maps names to SQL expressions over
    it; ``ranks`` are SQL expressions over the number of rows ``n`` for the 1-based
    ranks, which lie close to ``probs`` times n.  Rows are ordered by value, nulls
    first, then by the unique ``tie``.  Without ``tie``, rows of equal value
    are interchangeable and nulls are left out.  ``kind`` is a type that holds all
    columns exactly, ``tie_kind`` the tie-break's: ranges split it only if it is a
    number."""
    split = bool(tie) and tie_kind != "string"
    near = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-NEAR, 0.0, NEAR)})
    points = [f"'{c}', array_distinct(percentile_approx({c}, array({', '.join(f'{p}D' for p in near)}), {ACCURACY}))" for c in columns]
    grid = f"percentile_approx(_tie, array({', '.join(f'{i / GRID}D' for i in range(1, GRID))}), {ACCURACY})" if split else "NULL"
    # the tie-break's range and each column's cell, found once a row.  Written as
    # lambdas: spelt out, they would make a method that the JVM does not compile.
    # Nulls come before all cells, and like a point hold ties only
    at = below("_s._tie", GRID - 1, "_tie") if split else "0"
    cell = ", ".join(f"IF({c} IS NULL, -1, aggregate(_s.{c}, 0, (a, x) -> a + IF({c} > x, 2, IF({c} = x, 1, 0)))) AS _cell_{c}" for c in columns)
    rows = f"SELECT *, {at} AS _at, {cell} FROM (SELECT *, (SELECT s FROM sel_points) AS _s FROM sel_values)"

    def one(c: str) -> str:
        # odd cells are points
        return (f"named_struct('name', '{c}', 'value', {c}, '_tie', _tie, 'cell', _cell_{c},"
                f" 'sub', IF(_cell_{c} % 2 <> 0, _at, 0))")

    wanted = ", ".join(f"named_struct('k', {k}, 'rank', CAST({r} AS BIGINT))" for k, r in enumerate(ranks))
    names = ", ".join(f"'{c}'" for c in columns)
    # the cells of a column (some thousand) are run through in order, and the
    # ranks that fall into each are noted
    return f"""
sel_values AS (SELECT {", ".join(f"CAST({e} AS {kind}) AS {c}" for c, e in columns.items())}, CAST({tie or 'NULL'} AS {tie_kind}) AS _tie FROM {src}),
sel_points AS (SELECT named_struct({", ".join(points)}, '_tie', {grid}) AS s FROM sel_values),
sel_rows AS (SELECT inline(array({", ".join(map(one, columns))})) FROM ({rows})),
sel_cells AS (SELECT * FROM sel_rows{"" if tie else " WHERE cell >= 0"}),
sel_counts AS (SELECT array_sort(collect_list(named_struct('name', name, 'cell', cell, 'sub', sub, 'rows', rows))) AS cells
  FROM (SELECT name, cell, sub, COUNT(*) AS rows FROM sel_cells GROUP BY name, cell, sub)),
sel_columns AS (SELECT cells, aggregate(cells, 0L, (t, x) -> t + x.rows) AS n
  FROM (SELECT explode(transform(array({names}), c -> filter(cells, x -> x.name = c))) AS cells FROM sel_counts)),
sel_cuts AS (SELECT flatten(collect_list(aggregate(cells,
    named_struct('upto', 0L, 'cuts', CAST(array() AS ARRAY<STRUCT<name: STRING, cell: INT, sub: INT, k: INT, nth: BIGINT, n: BIGINT>>)),
    (t, x) -> named_struct('upto', t.upto + x.rows, 'cuts', concat(t.cuts, transform(filter(ranks, r -> r.rank > t.upto AND r.rank <= t.upto + x.rows),
      r -> named_struct('name', x.name, 'cell', x.cell, 'sub', x.sub, 'k', r.k, 'nth', r.rank - t.upto, 'n', n)))),
    t -> t.cuts))) AS c
  FROM (SELECT *, array({wanted}) AS ranks FROM sel_columns)),
sel_near AS (SELECT name, value, _tie, inline(filter(_cuts, c -> c.name = name AND c.cell = cell AND c.sub = sub)) AS (_n, _c, _s, k, nth, n)
  FROM (SELECT *, (SELECT c FROM sel_cuts) AS _cuts FROM sel_cells)),
sel_found AS (SELECT array_sort(collect_list(named_struct('name', name, 'k', k, 'value', value, 'tie', _tie, 'n', n))) AS found
  FROM (SELECT *, row_number() OVER (PARTITION BY name, k ORDER BY value NULLS FIRST, _tie) AS number FROM sel_near) WHERE number = nth),
at_ranks AS (SELECT map_from_entries(transform(array({names}), c -> named_struct('name', c, 'at', named_struct(
    'n', try_element_at(filter(found, x -> x.name = c), 1).n,
    'at', transform(filter(found, x -> x.name = c), x -> named_struct('value', x.value, 'tie', x.tie)))))) AS m FROM sel_found)"""


def ntile_sql(src: str, n: int, scores: dict[str, str], tie: str, kind: str = KIND, tie_kind: str = "bigint") -> tuple[str, str]:
    """CTEs and a SELECT of ``src.*`` with ``NTILE(n) OVER (ORDER BY value,
    tie)`` for several values at once: ``scores`` maps each result column to the
    SQL expression of its value."""
    # the first n_rows % n tiles have one row more; with fewer rows than tiles
    # the ranks repeat the last row, after which no row comes
    last = [f"n DIV {n} * {k} + LEAST({k}, n % {n})" for k in range(1, n)]

    def tile(name: str, value: str) -> str:
        # structs compare by value, nulls first, then by tie
        row = f"named_struct('value', CAST({value} AS {kind}), 'tie', CAST({tie} AS {tie_kind}))"
        return f"1 + size(filter(_cuts['{name}'].at, c -> {row} > c)) AS {name}"

    ctes = order_statistics_sql(src, scores, [k / n for k in range(1, n)], last, tie, kind, tie_kind)
    return ctes, (f"SELECT * EXCEPT (_cuts), {', '.join(tile(c, e) for c, e in scores.items())}"
                  f" FROM (SELECT *, (SELECT m FROM at_ranks) AS _cuts FROM {src})")


def shared(df: DataFrame) -> DataFrame:
    """``df`` behind one exchange that all readers of it in a plan can reuse: its
    rows travel as one struct, so no reader's exchange lacks columns."""
    return df.select(F.struct("*").alias("_row")).hint("rebalance").select("_row.*")


def ntile_scores(df: DataFrame, n: int, scores: dict[str, str], tie: str, kind: str = KIND) -> DataFrame:
    """``df`` with the columns of ``ntile_sql``."""
    tie_kind = "bigint" if isinstance(df.schema[tie].dataType, IntegralType) else "string"
    ctes, select = ntile_sql("{src}", n, scores, tie, kind, tie_kind)
    return df.sparkSession.sql(f"WITH {ctes} {select}", src=shared(df))


def quantile_edges_sql(src: str, columns: dict[str, int], probs: Sequence[float], kind: str = KIND) -> str:
    """CTEs, the last of which is ``edges(e)``: one row, a map of column name to
    the array of its exact quantiles, interpolated linearly between neighbouring
    rows (as ``quantile_cont`` does), as doubles; nulls are left out.  ``columns``
    maps each column to its unit: 100 for money in cents, 1 for a whole number."""
    ranks = [f"{f}((n - 1) * {p}D) + 1" for p in probs for f in ("FLOOR", "CEIL")]
    unit = "CASE k " + " ".join(f"WHEN '{c}' THEN {u}D" for c, u in columns.items()) + " END"
    a, b = f"CAST(x.at[{{0}}].value AS DOUBLE) / {unit}", f"CAST(x.at[{{1}}].value AS DOUBLE) / {unit}"
    each = [f"{a} + ({b} - {a}) * ((x.n - 1) * {p}D - FLOOR((x.n - 1) * {p}D))".format(2 * i, 2 * i + 1) for i, p in enumerate(probs)]
    values = {c: c if u == 1 else f"{c} * {u}" for c, u in columns.items()}
    return order_statistics_sql(src, values, probs, ranks, kind=kind) + f""",
edges AS (SELECT transform_values(map_filter(m, (k, x) -> x.n IS NOT NULL), (k, x) -> array({", ".join(each)})) AS e FROM at_ranks)"""


def quantile_bins(df: DataFrame, columns: dict[str, tuple[str, Sequence[int], int]], probs: Sequence[float],
                  kind: str = KIND) -> DataFrame:
    """``df`` with quantile bins: ``columns`` maps each column to its result's
    name, labels and unit.  Bins are closed on the right, the lowest edge
    included; the label is that of the first edge that is not below the value."""
    def bin_of(c: str, out: str, labels: Sequence[int], _) -> str:
        whens = " ".join(f"WHEN CAST({c} AS DOUBLE) <= _e['{c}'][{i}] THEN {label}" for i, label in enumerate(labels, 1))
        return f"CAST(CASE {whens} END AS INT) AS {out}"

    ctes = quantile_edges_sql("{src}", {c: to[2] for c, to in columns.items()}, probs, kind)
    return df.sparkSession.sql(
        f"WITH {ctes} SELECT * EXCEPT (_e), {', '.join(bin_of(c, *to) for c, to in columns.items())}"
        f" FROM (SELECT *, (SELECT e FROM edges) AS _e FROM {{src}})", src=shared(df))
