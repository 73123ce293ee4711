"""From report shapes (outlines, stacked columns) to tidy rows.

A report is an ordered list of rows, so every operator here takes a row-number column. Rows of one
source are worked on in blocks of ``block_rows``: a task never holds more than one block, however
long the source is, and the value that reaches a block from the blocks before it is joined in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import DATETIME_FORMATS, file_company, file_group, parse_multi_datetime

# Small enough that the blocks which fall into one task by chance stay far below its memory.
BLOCK_ROWS = 1 << 17

SOURCE = ("source_file",)


def _dealt(blocked: DataFrame, source: Sequence[str]) -> DataFrame:
    """Blocks dealt to all shuffle partitions.

    With a number, adaptive execution doesn't coalesce them: sheets compress to few bytes a row, so partitions of its size
    would have millions of rows to sort.
    """
    parts = int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocked.repartition(parts, *source, "_block")


def _as_is(df: DataFrame) -> DataFrame:
    return df


def skip_preamble(df: DataFrame, n: int, order: str = "row_no") -> DataFrame:
    """Drop the title rows above the report body."""
    return df.where(F.col(order) >= n)


def with_file_identity(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add ``grp`` and ``company``, both read off the file name."""
    return df.withColumns({"grp": file_group(name), "company": file_company(name)})


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    *,
    order: str = "row_no",
    source: Sequence[str] = SOURCE,
    within: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Replace nulls in ``cols`` by the last value above them in the same source.

    ``within`` restricts the look-back to rows with the same key values; a row with a null key gets
    nulls. ``order`` counts the rows of a source from 0 and is unique in it.
    """
    return forward_fill_steps(df, [(cols, within)], order=order, source=source, block_rows=block_rows)


def forward_fill_steps(
    df: DataFrame,
    steps: Sequence[tuple[Sequence[str], Sequence[str]]],
    *,
    order: str = "row_no",
    source: Sequence[str] = SOURCE,
    block_rows: int = BLOCK_ROWS,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Several fills one after the other, each ``(cols, within)``; later keys may be filled columns.

    All steps share one shuffle by source and block. ``stage`` materialises what the blocks hand on, a few rows each:
    without it, every step derives anew what all steps before it have handed on.
    """
    stage = stage or _as_is
    filled = df.withColumn("_block", F.floor(F.col(order) / block_rows))
    # Only sources longer than a block hand values on; where there is none, adaptive execution
    # drops everything that hangs on them.
    long_sources = stage(df.where(F.col(order) >= block_rows).select(*source).distinct())
    used = dict.fromkeys(c for cols, within in steps for c in (*cols, *within))
    long_rows = filled.select(*source, "_block", order, *used).join(long_sources, list(source), "left_semi")
    filled = _dealt(filled, source)
    for n, (cols, within) in enumerate(steps):
        scope = [*source, *within]
        carried = stage(_handed_over(long_rows, list(cols), order, scope))
        if n < len(steps) - 1:
            long_rows = _dealt(long_rows, source) if n == 0 else long_rows
            long_rows = _fill(long_rows, carried, list(cols), order, list(source), list(within))
        filled = _fill(filled, carried, list(cols), order, list(source), list(within))
    return filled.select(*df.columns)


def fill_from_headers(
    df: DataFrame,
    steps: Sequence[tuple[Sequence[str], Sequence[str]]],
    *,
    order: str = "row_no",
    source: Sequence[str] = SOURCE,
    block_rows: int = BLOCK_ROWS,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``forward_fill_steps`` for sheets where few rows have a value in any of the columns to fill: their headers.

    A header row holds for the rows below it up to the next one. So the steps are taken on the headers alone, and all
    rows get the state of their last header in one pass: the rows are sorted once, however many steps there are.
    ``stage`` materialises the filled headers, which are read twice.
    """
    stage = stage or _as_is
    cols = list(dict.fromkeys(c for own, _ in steps for c in own))
    is_header = _any_present(cols)
    headers = stage(forward_fill_steps(df.where(is_header), steps, order=order, source=source, block_rows=block_rows, stage=stage))
    state = F.struct(*cols)
    marked = headers.withColumn("_state", state).unionByName(df.where(~is_header), allowMissingColumns=True)
    marked = _dealt(marked.withColumn("_block", F.floor(F.col(order) / block_rows)), source)
    so_far = Window.partitionBy(*source, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumn("_state", F.last("_state", ignorenulls=True).over(so_far))
    # what the blocks of a long source receive: the last header of the blocks before
    ends = headers.withColumn("_block", F.floor(F.col(order) / block_rows)).groupBy(*source, "_block").agg(F.max_by(state, order).alias("_carried"))
    following = Window.partitionBy(*source).orderBy("_block")
    spans = ends.select(
        *[F.col(c).alias(f"_on_{c}") for c in source], "_carried", (F.col("_block") + 1).alias("_from"), F.lead("_block").over(following).alias("_to")
    )
    last_blocks = df.where(F.col(order) >= block_rows).groupBy(*[F.col(c).alias(f"_on_{c}") for c in source]).agg(F.floor(F.max(order) / block_rows).alias("_end"))
    received = (
        spans.join(last_blocks, [f"_on_{c}" for c in source])
        .withColumn("_to", F.least(F.coalesce("_to", "_end"), "_end"))
        .where("_from <= _to")
        .select(*[f"_on_{c}" for c in source], "_carried", F.explode(F.sequence("_from", "_to")).alias("_on__block"))
    )
    matched = [F.col(c) == F.col(f"_on_{c}") for c in (*source, "_block")]
    filled = F.coalesce("_state", "_carried")
    return local.join(received, matched, "left").withColumns({c: filled[c] for c in cols}).select(*df.columns)


def _handed_over(long_rows: DataFrame, cols: list[str], order: str, scope: list[str]) -> DataFrame:
    """What each block receives per scope: the last values of the blocks before it."""
    last_of_block = long_rows.groupBy(*scope, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    )
    before = Window.partitionBy(*scope).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return last_of_block.select(
        *[F.col(c).alias(f"_on_{c}") for c in (*scope, "_block")],
        *[F.last(c, ignorenulls=True).over(before).alias(f"_carried_{c}") for c in cols],
    ).where(_any_present([f"_carried_{c}" for c in cols]))


def _fill(
    blocked: DataFrame, carried: DataFrame, cols: list[str], order: str, source: list[str], within: list[str]
) -> DataFrame:
    so_far = (
        Window.partitionBy(*source, "_block", *within)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = blocked.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in cols})
    matched = [F.col(c) == F.col(f"_on_{c}") for c in (*source, *within, "_block")]
    filled = {c: F.coalesce(F.col(c), F.col(f"_carried_{c}")) for c in cols}
    if within:
        keyed = F.lit(True)
        for key in within:
            keyed = keyed & F.col(key).isNotNull()
        filled = {c: F.when(keyed, value) for c, value in filled.items()}
    return local.join(carried, matched, "left").withColumns(filled).select(*blocked.columns)


def outline_flatten(
    df: DataFrame,
    levels: Mapping[int, str],
    leaf: str,
    *,
    measure: str = "c1",
    measure_name: str = "change",
    label: str = "c0",
    level: str = "level",
    order: str = "row_no",
    source: Sequence[str] = SOURCE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per leaf of an outline, with every ancestor's label beside it.

    ``levels`` names the outline levels to keep. Each ancestor keeps its last label until the next
    one, also where the levels between have changed.
    """
    keep = [c for c in df.columns if c not in (measure, label, level)]
    spread = df.select(
        *keep,
        F.col(measure).alias(measure_name),
        *[F.when(F.col(level) == depth, F.col(label)).alias(name) for depth, name in levels.items()],
    )
    ancestors = [name for name in levels.values() if name != leaf]
    # rows of other levels neither hand anything down nor come out
    spread = spread.where(_any_present(levels.values()))
    filled = forward_fill(spread, ancestors, order=order, source=source, block_rows=block_rows)
    return filled.where(F.col(leaf).isNotNull())


def classify_stacked(
    df: DataFrame,
    rules: Callable[..., Mapping[str, Column]],
    *also: str,
    stacked: str = "stacked",
    formats: Iterable[str] = DATETIME_FORMATS,
) -> DataFrame:
    """Split a stacked report column into typed columns; a row that fits no class has nulls.

    Text that reads as a datetime goes to ``date``. ``rules`` gets the other text, and the columns
    named in ``also``, and returns one column per further class.
    """
    dated = df.withColumn("date", parse_multi_datetime(stacked, formats).cast("date"))
    named = dated.withColumn("_text", F.when(F.col("date").isNull(), F.col(stacked)))
    classes = rules(F.col("_text"), *[F.col(c) for c in also])
    return named.withColumns(dict(classes)).drop("_text")


def _any_present(cols: Iterable[str]) -> Column:
    present = F.lit(False)
    for c in cols:
        present = present | F.col(c).isNotNull()
    return present
