"""Sheets cut into chunks that carry rows from elsewhere in the sheet, and the prompts that such cuts are asked for with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.content import _let, sheet_parts

HEADER_ROWS, OVERLAP_ROWS = 5, 3


def cell_text(line: Column) -> Column:
    """A row's cells without its number."""
    return F.trim(F.regexp_replace(line, r"^[^|]*\|[^|]*\|", ""))


def first_by_cells(lines: Column) -> Column:
    """Lines whose cells no line before them has."""
    return _let(F.transform(lines, cell_text), lambda cells: F.filter(lines, lambda x, i: F.array_position(cells, cell_text(x)) == i + 1))


def _joined(lines: Column) -> Column:
    return F.array_join(lines, "\n")


Of = Callable[[Column], Column]


def context_chunks(pages: DataFrame, key: Sequence[str], text: str, breaks: Of, sheet_rows: Of, section_rows: Of) -> DataFrame:
    """(key, chunk_no, chunk_context, chunk_text, sheet_passthrough, section_passthrough) of sheets.

    Of the sheet's parts, ``breaks`` gives the row numbers that begin a chunk; ``sheet_rows`` those of the rows that every chunk carries, each content once, below the
    table's header; ``section_rows``, for each of the breaks in ascending order, those of the rows that the chunk carries unless they are its own. Numbers that no row has
    are ignored; pages without numbered rows give nothing. Block quotes go to the last chunk."""
    none = F.array().cast("array<string>")

    def lines_of_number(rows: Column, n: Column) -> Column:
        # of rows with the same number the last counts
        own = F.transform(F.filter(rows, lambda r: r["row_no"] == n), lambda r: r["line"])
        return F.slice(own, F.greatest(F.size(own), F.lit(1)), F.lit(1))

    def chunk(parts: Column, sections: Column, starts: Column, carried: Column, s: Column, i: Column) -> Column:
        rows = parts["rows"]
        last = F.coalesce(F.get(starts, i + 1) - 1, F.size(rows))
        quotes = F.when((i == F.size(starts) - 1) & (F.size(parts["visuals"]) > 0), F.concat(F.array(F.lit("")), parts["visuals"])).otherwise(none)

        def filled(own: Column) -> Column:
            wanted = F.flatten(F.transform(F.coalesce(F.get(sections, i - 1), F.array().cast("array<int>")), lambda n: lines_of_number(rows, n)))
            return F.struct(
                (i + 1).alias("chunk_no"),
                F.format_string("Rows %d-%d", F.get(own, F.lit(0))["row_no"], F.get(own, F.size(own) - 1)["row_no"]).alias("chunk_context"),
                _joined(F.concat(F.transform(own, lambda r: r["line"]), quotes)).alias("chunk_text"),
                carried.alias("sheet_passthrough"),
                _joined(F.when(i > 0, F.filter(wanted, lambda x: ~F.exists(own, lambda r: r["line"] == x))).otherwise(none)).alias("section_passthrough"),
            )

        return _let(F.slice(rows, s, last - s + 1), filled)

    def chunks(parts: Column) -> Column:
        rows = parts["rows"]
        places = F.sequence(F.lit(1), F.greatest(F.size(rows), F.lit(1)))
        starts = _let(breaks(parts), lambda bs: F.filter(places, lambda i: (i == 1) | F.array_contains(bs, F.get(rows, i - 1)["row_no"])))
        carried = _let(sheet_rows(parts), lambda ns: first_by_cells(F.transform(F.filter(rows, lambda r: F.array_contains(ns, r["row_no"])), lambda r: r["line"])))
        head = F.filter(F.array(parts["header"], parts["separator"]), lambda x: x.isNotNull())
        shown = _let(carried, lambda c: F.when(F.size(c) > 0, _joined(F.concat(head, c))).otherwise(""))
        known = F.struct(starts.alias("starts"), shown.alias("carried"), section_rows(parts).alias("sections"))
        return _let(known, lambda k: F.transform(k["starts"], lambda s, i: chunk(parts, k["sections"], k["starts"], k["carried"], s, i)))

    own = _let(sheet_parts(F.col(text)), lambda parts: F.when(F.size(parts["rows"]) > 0, chunks(parts)))
    return pages.select(*key, F.explode(own).alias("_c")).select(*key, "_c.*")


def prompts(pages: DataFrame, key: Sequence[str], text: str, rows_per_batch: int = 50, header: int = HEADER_ROWS, overlap: int = OVERLAP_ROWS) -> DataFrame:
    """(key, batch_no, prompt): a sheet's rows in batches, each with the sheet's first rows and the last rows of the batch before it."""
    parsed = pages.select(*key, sheet_parts(F.col(text)).alias("parts")).where(F.size("parts.rows") > 0)
    lines = F.col("parts.rows.line")
    numbered = parsed.select(*key, "parts", F.explode(F.sequence(F.lit(0), (F.ceil(F.size("parts.rows") / F.lit(rows_per_batch)) - 1).cast("int"))).alias("_i"))
    before = F.when(F.col("_i") > 0, F.slice(lines, F.col("_i") * rows_per_batch - overlap + 1, overlap)).otherwise(F.array().cast("array<string>"))
    return numbered.select(
        *key, (F.col("_i") + 1).alias("batch_no"), _joined(F.concat(F.slice(lines, 1, header), before, F.slice(lines, F.col("_i") * rows_per_batch + 1, rows_per_batch))).alias("prompt")
    )
