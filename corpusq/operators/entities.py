"""Entity pages to records, statistics tables and reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.functions import html as H
from corpusq.functions import prompts as P
from corpusq.functions import text as X
from corpusq.functions.text import let
from corpusq.operators.infer import Scorer, batch_score

# What a page calls its fields.
POSITION_LABEL = "Position"
CLUB_LABEL = "Club"
BIRTHDAY_ID = "necro-birth"
REQUIRED_COLUMN = "Statistic"


def entity_fields(df: DataFrame, as_of: Column, html: str = "html") -> DataFrame:
    """Adds position, birthday, age and club; a field that is not there is ``Unknown``."""
    page = F.col(html)
    return (
        df.withColumn("position", X.or_unknown(H.label_field(page, POSITION_LABEL)))
        .withColumn("birthday", X.or_unknown(H.element_by_id(page, BIRTHDAY_ID)))
        .withColumn("age", X.or_unknown(X.age_in_years(F.col("birthday"), as_of)))
        .withColumn("club", X.or_unknown(H.last_colon_segment(page, CLUB_LABEL)))
    )


def page_table(df: DataFrame, key: str, table_id: str, columns: Sequence[str], html: str = "html") -> DataFrame:
    """``(key, row_idx, *columns)``: the body rows of the first table with the id.

    Cells are found by the names in the header row, wherever those stand; a column
    that the header lacks is NULL.
    """
    rows = H.table_rows(F.col(html), table_id)
    return (
        df.select(key, F.posexplode(let(rows, lambda r: named_cells(r, columns))).alias("row_idx", "_cells"))
        .select(key, "row_idx", *[F.get("_cells", i).alias(name) for i, name in enumerate(columns)])
    )


def named_cells(rows: Column, columns: Sequence[str]) -> Column:
    """The body rows with their cells in the order of ``columns``, looked up in the header row."""
    head = F.get(rows, 0)
    at = F.array(*[F.array_position(F.transform(head, lambda c: F.coalesce(c, F.lit(""))), F.lit(n)).cast("int") for n in columns])

    def ordered(places: Column) -> Column:
        cells = lambda r: F.transform(places, lambda p: F.when(p > 0, F.get(r, p - 1)))
        return F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), cells)

    return F.when(F.size(rows) > 0, let(at, ordered)).otherwise(F.array().cast("array<array<string>>"))


def drop_missing(df: DataFrame, columns: Sequence[str] = (REQUIRED_COLUMN,)) -> DataFrame:
    return df.dropna(subset=list(columns))


def markdown_line(cells: Sequence[Column]) -> Column:
    """One table row, ``| a | b |``; a NULL cell is empty, and a pipe in a cell is escaped."""
    shown = [F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in cells]
    joined = F.concat_ws(" | ", *shown)
    return F.concat(F.lit("| "), joined, F.lit(" |"))


def markdown_head(columns: Sequence[str]) -> str:
    return "| " + " | ".join(columns) + " |\n|" + " --- |" * len(columns)


def rows_to_markdown(
    df: DataFrame, key: str, order: str, columns: Sequence[str], out: str = "markdown", block_rows: int = 4096
) -> DataFrame:
    """One markdown table per key from exploded rows.

    Lines are joined per block of the dense order first, so that a key with many
    rows is not collected row by row in one task.
    """
    lines = df.select(
        key,
        F.col(order).alias("_order"),
        F.floor(F.col(order) / block_rows).alias("_block"),
        markdown_line([F.col(c) for c in columns]).alias("_line"),
    )

    def join_sorted(grouped, by: str) -> Column:
        rows = F.sort_array(F.collect_list(F.struct(by, "_line")))
        return F.array_join(F.transform(rows, lambda r: r["_line"]), "\n")

    blocks = lines.groupBy(key, "_block").agg(join_sorted(lines, "_order").alias("_line"))
    body = blocks.groupBy(key).agg(join_sorted(blocks, "_block").alias("_body"))
    return body.select(key, F.concat(F.lit(markdown_head(columns) + "\n"), F.col("_body")).alias(out))


def table_to_markdown(rows: Column, columns: Sequence[str]) -> Column:
    """As ``rows_to_markdown`` for a table that is still an array in its page's row.

    Cells are found by the header's names. Rows whose first column is missing are left out. A table without
    rows, and a page without the table, give NULL, as they give no row there.
    """

    def joined(body: Column) -> Column:
        lines = F.transform(body, lambda r: markdown_line([F.get(r, i) for i in range(len(columns))]))
        return F.when(F.size(body) > 0, F.concat_ws("\n", F.lit(markdown_head(columns)), F.array_join(lines, "\n")))

    return let(let(rows, lambda r: F.filter(named_cells(r, columns), lambda c: F.get(c, 0).isNotNull())), joined)


def entity_reports(
    df: DataFrame,
    *,
    name: str,
    table_id: str,
    columns: Sequence[str],
    as_of: Column,
    html: str = "html",
    max_new_tokens: int = 100,
    factory: Callable[[], Scorer] | None = None,
) -> DataFrame:
    """Fields, statistics and page text into one prompt per entity, scored in batches."""
    ready = entity_fields(df, as_of, html).withColumns(
        {
            "statistics": table_to_markdown(H.table_rows(F.col(html), table_id), columns),
            "text": H.page_text(F.col(html)),
        }
    )
    names = ("position", "age", "club", "statistics", "text")
    prompt = P.render(P.REPORT_TEMPLATE, {"name": F.col(name), **{n: F.col(n) for n in names}})
    asked = ready.withColumn("prompt", prompt).withColumn(
        "max_new_tokens", F.lit(max_new_tokens).cast("long")
    )
    return batch_score(asked, factory, out="report", content=F.col("text"))
