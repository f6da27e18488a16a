"""Pages, chunks and sections: tiers, layouts, splitting, packing, naming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EMBEDDING_LIMIT, TRUNCATION_LIMIT = 8192, 80_000
# Prefixes of list lines and words that mark pictures, as the layout labels are defined.
BULLETS = ("- ", "* ", "• ", "1. ", "2. ", "3. ")
VISUAL_WORDS = ("![", "chart", "diagram", "figure", "image", "photo", "screenshot")


def lines_of(text: Column) -> Column:
    """Trimmed lines that are not blank."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda x: F.btrim(x, F.lit(" \t\r\n\f\u000b")))
    return F.filter(parts, lambda x: x != "")


def token_tier(tokens: Column) -> Column:
    return F.when(tokens <= 5000, "low").when(tokens <= 10000, "medium").otherwise("high")


def table_lines(lines: Column) -> Column:
    """Number of lines between two pipes."""
    return F.size(F.filter(lines, lambda x: x.startswith("|") & x.endswith("|") & (F.length(x) >= 2)))


def bullet_lines(lines: Column) -> Column:
    def is_bullet(x: Column) -> Column:
        hit = F.lit(False)
        for b in BULLETS:
            hit = hit | x.startswith(b)
        return hit

    return F.size(F.filter(lines, is_bullet))


def has_visual(text: Column) -> Column:
    lower, hit = F.lower(F.coalesce(text, F.lit(""))), F.lit(False)
    for word in VISUAL_WORDS:
        hit = hit | F.contains(lower, F.lit(word))
    return hit


def layout_type(filetype: Column, text: Column, tier: Column) -> Column:
    """A page's layout label. NULL and blank texts are empty, but for sheets and slides, which go by file type."""
    counts = _let(lines_of(text), lambda ls: F.struct(F.size(ls).alias("lines"), table_lines(ls).alias("table"), bullet_lines(ls).alias("bullets")))

    def label(c: Column) -> Column:
        return (
            F.when(c["lines"] == 0, "empty")
            .when(c["table"] >= 4, F.when(tier == "high", "dense_table").otherwise("table"))
            .when(has_visual(text) | (c["bullets"] >= 4), "visual_heavy")
            .when(tier == "high", "longform_text")
            .otherwise("narrative_text")
        )

    return F.when(filetype == "xlsx", "spreadsheet").when(filetype == "pptx", "presentation_slide").otherwise(_let(counts, label))


def words_of(text: Column) -> Column:
    """Tokens of the deterministic counter: runs of characters other than white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\r\n]+"), 0)


def truncated(text: Column, limit: int = TRUNCATION_LIMIT) -> Column:
    """The first ``limit`` tokens; a text within the limit stands as it is."""
    words = words_of(text)
    return F.when(F.size(words) > limit, F.array_join(F.slice(words, 1, limit), " ")).otherwise(text)


def embedding_text(parts: Sequence[Column]) -> Column:
    """Parts that are not blank, each on its line."""
    return F.concat_ws("\n", *[F.nullif(F.coalesce(p, F.lit("")), F.lit("")) for p in parts])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_at(lines: Column, breakpoints) -> Column:
    """Array of (first, last, text) of the pieces of numbered lines; ``breakpoints`` maps the lines to the 1-based numbers of those that
    begin a piece. Numbers out of range and repeated ones are ignored. Inside the row: nothing is exploded or shuffled."""

    def pieces(ls: Column) -> Column:
        n = F.size(ls)
        starts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1)), F.filter(breakpoints(ls), lambda b: (b > 1) & (b <= n)))))
        return _let(starts, lambda ss: F.transform(ss, lambda s, i: _piece(ls, s, F.coalesce(F.get(ss, i + 1) - 1, F.size(ls)))))

    return _let(lines, pieces)


def _piece(lines: Column, first: Column, last: Column) -> Column:
    return F.struct(first.alias("first"), last.alias("last"), F.array_join(F.slice(lines, first, last - first + 1), "\n").alias("text"))


def heading_breaks(lines: Column) -> Column:
    """The offline breakpoint provider: every heading begins a piece."""
    return F.filter(F.transform(lines, lambda x, i: F.when(x.startswith("#"), i + 1)), lambda x: x.isNotNull())


def markdown_chunks(pages: DataFrame, key: Sequence[str], text: str, breaks=heading_breaks) -> DataFrame:
    """(key, chunk_no, chunk_context, chunk_text) of each page, split at its breakpoints; one chunk if there are none."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n")
    pieces = split_at(lines, breaks)
    return pages.select(*key, F.posexplode(pieces).alias("_i", "_p")).select(
        *key, (F.col("_i") + 1).alias("chunk_no"), F.format_string("Lines %d-%d", F.col("_p.first"), F.col("_p.last")).alias("chunk_context"), F.col("_p.text").alias("chunk_text")
    )


def word_count(text: Column) -> Column:
    """The number of longest runs of characters other than white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\r\n]+")), F.lit(0))


def packed_breaks(limit: int, count=word_count):
    """The offline provider for pieces over the limit: as many whole lines to a piece as the limit holds."""

    def breaks(lines: Column) -> Column:
        sizes = F.transform(lines, lambda x, i: F.struct(count(x).alias("n"), (i + 1).alias("at")))
        none = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("breaks"))

        def add(state: Column, line: Column) -> Column:
            over = (state["total"] > 0) & (state["total"] + line["n"] > limit)
            return F.struct(
                F.when(over, line["n"]).otherwise(state["total"] + line["n"]).alias("total"),
                F.when(over, F.concat(state["breaks"], F.array(line["at"]))).otherwise(state["breaks"]).alias("breaks"),
            )

        return F.aggregate(sizes, none, add, lambda state: state["breaks"])

    return breaks


def chunks_within(pages: DataFrame, key: Sequence[str], text: str, limit: int = EMBEDDING_LIMIT, breaks=heading_breaks, again=None, retries: int = 2, count=word_count) -> DataFrame:
    """(key, chunk_no, chunk_text, token_count) of each page: split at its breakpoints, recounted, and what is over the limit split
    again at those of ``again`` up to ``retries`` times. A piece that is then still over the limit, as one long line, is an error."""
    again = again or packed_breaks(limit, count)

    def pieces(body: Column, at) -> Column:
        return F.transform(split_at(F.split(body, r"\r\n|\r|\n"), at), lambda p: p["text"])

    rows = pages.select(*key, pieces(F.coalesce(text, F.lit("")), breaks).alias("_chunks"))
    for _ in range(retries):
        rows = rows.withColumn("_chunks", F.flatten(F.transform("_chunks", lambda c: F.when(count(c) > limit, pieces(c, again)).otherwise(F.array(c)))))
    rows = rows.select(*key, F.posexplode("_chunks").alias("_i", "chunk_text")).withColumn("_n", count(F.col("chunk_text")))
    error = F.raise_error(F.format_string(f"a chunk of %d tokens is over the limit of {limit} after {retries} retries", F.col("_n"))).cast("int")
    return rows.select(*key, (F.col("_i") + 1).alias("chunk_no"), "chunk_text", F.when(F.col("_n") > limit, error).otherwise(F.col("_n")).alias("token_count"))


def regions_to_extract(regions: Column, skipped: Sequence[str] = ("legend",)) -> Column:
    """Those of an array of (region_type, requires_region_extraction) that are cut out and read on their own."""
    return F.filter(regions, lambda r: F.coalesce(r["requires_region_extraction"], F.lit(False)) & ~F.lower(F.coalesce(r["region_type"], F.lit(""))).isin(*skipped))


def preview_sizes(most: int) -> list[int]:
    """The sizes in tokens of the previews of a judge's attempts, each smaller than the one before."""
    return list(dict.fromkeys([most, max(60, most // 2), max(40, most // 3)]))


def preview(text: Column, tokens: int) -> Column:
    return F.when(F.length(text) > tokens * 4, F.concat(F.substring(text, 1, tokens * 4), F.lit("..."))).otherwise(text)


def sheet_parts(text: Column) -> Column:
    """Struct of a sheet's markdown: heading, header row, separator, numbered rows (row_no, line), block quotes after the first of which
    rows no longer count."""
    return _let(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n"), _sheet_parts)


def _sheet_parts(lines: Column) -> Column:
    first_quote = F.array_position(F.transform(lines, lambda x: x.startswith(">")), True)
    table_part = F.when(first_quote > 0, F.slice(lines, 1, (first_quote - 1).cast("int"))).otherwise(lines)
    rows = F.transform(
        F.filter(table_part, lambda x: x.rlike(r"^\|\s*\d+\s*\|")),
        lambda x: F.struct(F.regexp_extract(x, r"^\|\s*(\d+)\s*\|", 1).cast("int").alias("row_no"), x.alias("line")),
    )
    return F.struct(
        F.get(F.filter(lines, lambda x: x.startswith("#")), F.lit(0)).alias("heading"),
        F.get(F.filter(lines, lambda x: x.startswith("| Row |")), F.lit(0)).alias("header"),
        F.get(F.filter(lines, lambda x: x.startswith("| ---")), F.lit(0)).alias("separator"),
        rows.alias("rows"),
        F.filter(lines, lambda x: x.startswith(">")).alias("visuals"),
    )


def sheet_chunks(pages: DataFrame, key: Sequence[str], text: str, rows_per_chunk: int = 50) -> DataFrame:
    """(key, chunk_no, chunk_context, chunk_header, n_rows, chunk_text) of sheets: rows in chunks, each with the sheet's header; the
    block quotes go to the last one. Pages without numbered rows give none."""
    parsed = pages.select(*key, sheet_parts(F.col(text)).alias("s")).where(F.size("s.rows") > 0)
    count = F.ceil(F.size("s.rows") / F.lit(rows_per_chunk)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct((i + 1).alias("no"), F.slice(F.col("s.rows"), i * rows_per_chunk + 1, rows_per_chunk).alias("rows"), (i == count - 1).alias("is_last")))
    return parsed.select(*key, "s", F.explode(chunks).alias("c")).select(
        *key,
        F.col("c.no").alias("chunk_no"),
        F.format_string("Rows %d-%d", F.get("c.rows", F.lit(0))["row_no"], F.element_at("c.rows", -1)["row_no"]).alias("chunk_context"),
        F.concat_ws("\n", "s.heading", "s.header", "s.separator").alias("chunk_header"),
        F.size("c.rows").alias("n_rows"),
        F.array_join(F.concat(F.col("c.rows.line"), F.when(F.col("c.is_last"), F.col("s.visuals")).otherwise(F.array().cast("array<string>"))), "\n").alias("chunk_text"),
    )


def greedy_batches(items: DataFrame, group: str, order: Sequence[str], size: str, budget: int) -> DataFrame:
    """(group, order..., size, batch): items in order, a new batch when the next would exceed the budget; an item beyond the budget is
    alone in its own. A fold over one document's items, which are numbers only."""
    entries = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("_size"))))
    zero = F.struct(F.lit(0).alias("batch"), F.lit(0).cast("bigint").alias("total"), F.array().cast("array<int>").alias("batches"))

    def step(state: Column, x: Column) -> Column:
        new = (state["batch"] == 0) | (state["total"] + x["_size"] > budget)
        batch = F.when(new, state["batch"] + 1).otherwise(state["batch"])
        return F.struct(batch.alias("batch"), F.when(new, x["_size"]).otherwise(state["total"] + x["_size"]).alias("total"), F.concat(state["batches"], F.array(batch)).alias("batches"))

    folded = items.groupBy(group).agg(entries.alias("_e")).select(group, "_e", F.aggregate("_e", zero, step)["batches"].alias("_b"))
    zipped = F.arrays_zip(F.col("_e").alias("e"), F.col("_b").alias("b"))
    return folded.select(group, F.explode(zipped).alias("z")).select(group, *[F.col(f"z.e.{o}").alias(o) for o in order], F.col("z.e._size").alias(size), F.col("z.b").alias("batch"))


def budget_prefix(items: DataFrame, group: str, order: Sequence[Column], size: str, budget: int) -> DataFrame:
    """Items of the longest prefix within the budget; the first is always kept."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    marked = items.withColumns({"_sum": F.sum(F.coalesce(F.col(size), F.lit(0))).over(w), "_no": F.row_number().over(Window.partitionBy(group).orderBy(*order))})
    return marked.where((F.col("_sum") <= budget) | (F.col("_no") == 1)).drop("_sum", "_no")


def unit_name(text: Column) -> Column:
    """The sheet's name, else the first heading, else ''."""
    sheet = F.regexp_extract(text, r"(?m)^#[ \t]+Sheet:[ \t]+(.+)$", 1)
    heading = F.regexp_extract(text, r"(?m)^#+[ \t]+(.+)$", 1)
    return F.coalesce(F.trim(F.when(sheet != "", sheet).otherwise(heading)), F.lit(""))


def one_row_per_page(pages: DataFrame, document: str = "document_version_id") -> DataFrame:
    """Of the rows of a page that without a chunk id, else the first by id."""
    rest = [c for c in pages.columns if c not in (document, "page_number")]
    rank = F.struct(F.coalesce("chunk_id", F.lit("")) != "", F.coalesce("chunk_id", F.lit("")), "page_result_id")
    return pages.groupBy(document, "page_number").agg(F.min_by(F.struct(*rest), rank).alias("_p")).select(document, "page_number", "_p.*")


def section_starts(pages: DataFrame, document: str = "document_version_id") -> DataFrame:
    """The offline section provider: a page that begins with a heading begins a section, and so does the first page."""
    p = one_row_per_page(pages, document)
    first = p.groupBy(document).agg(F.min("page_number").alias("_first"), F.max("page_number").alias("last_page"))
    title = F.regexp_extract(F.coalesce("raw_content", F.lit("")), r"^\s*#+[ \t]+([^\r\n]+)", 1)
    starts = p.join(first, document).withColumn("title", F.trim(title)).where((F.col("title") != "") | (F.col("page_number") == F.col("_first")))
    return starts.select(document, F.col("page_number").alias("start_page"), F.when(F.col("title") != "", F.col("title")).otherwise(F.format_string("Page %d", F.col("page_number"))).alias("title"), "last_page")


def section_ranges(starts: DataFrame, document: str = "document_version_id") -> DataFrame:
    """(document, section_id, title, page_start, page_end): a section ends before the next one begins, the last with the document."""
    w = Window.partitionBy(document).orderBy("start_page", "title")
    return starts.select(
        document,
        F.row_number().over(w).cast("string").alias("section_id"),
        "title",
        F.col("start_page").alias("page_start"),
        F.coalesce(F.lead("start_page").over(w) - 1, F.col("last_page")).alias("page_end"),
    )


def pages_in_sections(pages: DataFrame, sections: DataFrame, document: str = "document_version_id") -> DataFrame:
    """Each page with the section that began last before it: sections and pages are merged in page order and the last start is
    carried on, which is linear; a range join would compare all pairs of a document."""
    s = sections.select(document, F.col("page_start").alias("_at"), F.lit(0).alias("_kind"), F.struct("page_start", "page_end", "section_id", "title").alias("_s"), *[F.lit(None).cast(t).alias(c) for c, t in pages.dtypes if c not in (document, "section_id")])
    p = pages.drop("section_id").select(document, F.col("page_number").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(s.schema["_s"].dataType).alias("_s"), *[c for c in pages.columns if c not in (document, "section_id")])
    w = Window.partitionBy(document).orderBy("_at", "_kind", F.col("_s.title").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    carried = s.unionByName(p).withColumn("_last", F.last("_s", ignorenulls=True).over(w)).where("_kind = 1")
    return carried.select(document, *[c for c in pages.columns if c not in (document, "section_id")], F.col("_last.section_id").alias("section_id"), F.col("_last.title").alias("section_title"))


def deepest_sections(sections: DataFrame, document: str = "document_version_id") -> DataFrame:
    """(document, unit_id, section_id): of the sections that list a unit the last in order, so that a child overrides its parent."""
    return (
        sections.select(document, "section_id", "sequence", F.explode("chunk_ids").alias("unit_id"))
        .groupBy(document, "unit_id")
        .agg(F.max_by("section_id", F.struct("sequence", "section_id")).alias("section_id"))
    )


def progressive_toc(sections: DataFrame, document: str = "document_version_id", snippet: int = 80) -> DataFrame:
    """Each section with the list of those before it: id, title, page and the start of their text."""
    w = Window.partitionBy(document).orderBy("page_start", F.col("section_id").cast("int")).rowsBetween(Window.unboundedPreceding, -1)
    entry = F.concat_ws(" | ", "section_id", F.substring("title", 1, snippet), F.concat(F.lit("p."), F.col("page_start")))
    return sections.withColumn("toc", F.array_join(F.collect_list(entry).over(w), "; "))


def sheet_markdown(cells: DataFrame, key: Sequence[str], row: str, column: str, value: str) -> DataFrame:
    """Sheets of sparse cells (key, row, column, value) as markdown tables of the populated rows and columns; ``column`` is a number,
    shown in letters. A sheet is one string, so its cells meet in one task, as numbers and short texts."""
    text = F.replace(F.regexp_replace(F.coalesce(F.col(value), F.lit("")), "[\r\n]+", " "), F.lit("|"), F.lit("\\|"))
    used = cells.where(F.coalesce(value, F.lit("")) != "").select(*key, F.col(row).alias("_r"), F.col(column).alias("_c"), text.alias("_v"))
    columns = used.groupBy(*key).agg(F.array_sort(F.collect_set("_c")).alias("_columns"))
    rows = used.groupBy(*key, "_r").agg(F.map_from_entries(F.collect_list(F.struct("_c", "_v"))).alias("_cells")).join(columns, list(key))
    line = F.concat(F.lit("| "), F.col("_r").cast("string"), F.lit(" | "), F.array_join(F.transform("_columns", lambda c: F.coalesce(F.col("_cells")[c], F.lit(""))), " | "), F.lit(" |"))
    body = rows.select(*key, "_r", line.alias("_line")).groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_line"))), lambda x: x["_line"]), "\n").alias("_body"))
    head = F.concat(F.lit("| Row | "), F.array_join(F.transform("_columns", column_letters), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.size("_columns") + 1), " | "), F.lit(" |"))
    return body.join(columns, list(key)).select(*key, F.concat_ws("\n", head, rule, "_body").alias("markdown"))


def column_letters(n: Column) -> Column:
    """A column's number, from 1 to 18,278, in letters."""
    def letter(k: Column) -> Column:
        return F.chr((k % 26 + 65).cast("int"))

    one, two, three = n - 1, n - 27, n - 703
    return (
        F.when(n <= 26, letter(one))
        .when(n <= 702, F.concat(letter(F.floor(two / 26)), letter(two)))
        .otherwise(F.concat(letter(F.floor(three / 676)), letter(F.floor(three / 26)), letter(three)))
    )


def distinct_calls(rows: DataFrame, content: str, answer) -> DataFrame:
    """Rows with the answer of an expensive call on ``content``, made once for each distinct content; ``answer`` maps a DataFrame
    (digest, content) to (digest, answer)."""
    keyed = rows.withColumn("_digest", F.sha2(F.coalesce(F.col(content), F.lit("")), 256))
    once = keyed.groupBy("_digest").agg(F.first(content).alias(content))
    return keyed.join(answer(once), "_digest", "left").drop("_digest")


def natural_key(identifier: Column) -> Column:
    """Sorts dotted ids part by part, numbers by value and before texts; a blank id comes first."""
    parts = F.filter(F.split(F.coalesce(identifier, F.lit("")), r"\."), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(p.try_cast("bigint").isNull().alias("is_text"), F.coalesce(p.try_cast("bigint"), F.lit(0)).alias("number"), p.alias("text")))


def page_sections(pages: DataFrame, label: str = "Page", document: str = "document_version_id") -> DataFrame:
    """(document, section_id, title, page_start, page_end, chunk_ids, token_count): one section for each page. Its title is the sheet
    name of its first row that has one, else ``label`` and the page's number. Sections are numbered in page order."""
    sheet = F.trim(F.regexp_extract(F.coalesce("raw_content", F.lit("")), r"(?m)^#[ \t]+Sheet:[ \t]+([^\r\n]+)", 1))
    unit = F.coalesce(F.nullif("chunk_id", F.lit("")), F.col("page_number").cast("string"))
    key = F.struct(natural_key(F.col("chunk_id")), F.col("page_result_id"))
    grouped = pages.groupBy(document, "page_number").agg(
        F.min_by(F.when(sheet != "", sheet), F.when(sheet != "", key)).alias("_title"),
        F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), unit.alias("u")))), lambda x: x["u"]).alias("chunk_ids"),
        F.sum(F.coalesce("raw_token_count", F.lit(0))).alias("token_count"),
    )
    number = F.row_number().over(Window.partitionBy(document).orderBy("page_number"))
    return grouped.select(
        document,
        number.cast("string").alias("section_id"),
        F.coalesce("_title", F.format_string(f"{label} %d", F.col("page_number"))).alias("title"),
        F.col("page_number").alias("page_start"),
        F.col("page_number").alias("page_end"),
        "chunk_ids",
        "token_count",
    )


def chunk_subsections(pages: DataFrame, sections: DataFrame, document: str = "document_version_id") -> DataFrame:
    """(document, section_id, parent_section_id, title, unit_id): every chunk of a section's first page as a subsection of it."""
    chunks = pages.where(F.coalesce("chunk_id", F.lit("")) != "").select(document, F.col("page_number").alias("page_start"), "chunk_id", "chunk_context", "page_result_id")
    w = Window.partitionBy(document, "page_start").orderBy(natural_key(F.col("chunk_id")), "page_result_id")
    numbered = chunks.withColumn("_no", F.row_number().over(w))
    label = F.coalesce(F.nullif("chunk_context", F.lit("")), F.format_string("Chunk %d", F.col("_no")))
    joined = numbered.join(sections.select(document, "page_start", "section_id", "title"), [document, "page_start"])
    return joined.select(
        document,
        F.concat_ws(".", "section_id", "_no").alias("section_id"),
        F.col("section_id").alias("parent_section_id"),
        F.when(F.col("title") != "", F.concat_ws(" — ", "title", label)).otherwise(label).alias("title"),
        F.col("chunk_id").alias("unit_id"),
    )


def is_embeddable(level: Column, summary: Column) -> Column:
    return (level == "section") | ((level == "subsection") & (F.coalesce(summary, F.lit("")) != ""))


def series_text(categories: Column, values: Column, most: int = 12) -> Column:
    """Points of a chart series, ``category: value``; the shorter side is padded with blanks."""
    points = F.slice(F.arrays_zip(categories.alias("c"), values.alias("v")), 1, most)
    return F.array_join(F.transform(points, lambda p: F.concat(F.coalesce(p["c"].cast("string"), F.lit("")), F.lit(": "), F.coalesce(p["v"].cast("string"), F.lit("")))), "; ")


def valid_box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether a region's corners lie in the unit square, the first before the second."""
    return F.coalesce((x1 >= 0) & (x1 < x2) & (x2 <= 1) & (y1 >= 0) & (y1 < y2) & (y2 <= 1), F.lit(False))


def set_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that only one side has, as often as it has them more, with ``problem``: missing or unexpected."""
    missing = expected.exceptAll(actual).withColumn("problem", F.lit("missing"))
    return missing.unionByName(actual.exceptAll(expected).withColumn("problem", F.lit("unexpected")))


def updated(base: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows with the columns that came back for their key; others, and those that came back NULL, keep theirs."""
    new = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(new, list(keys), "left")
    return joined.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).drop(*[f"_new_{c}" for c in columns])


def extracted_units(pages: DataFrame, said: DataFrame, document: str = "document_version_id") -> DataFrame:
    """Units with the keywords and entities that an extraction's answers (document, payload) give them, by unit id: the chunk's id or the page's number.

    An answer counts only if all its items have an id and none twice; a unit without an item, or with NULL lists, gets empty ones."""
    from folioflow.providers import parsed_answer, valid_items

    items = said.select(document, parsed_answer(F.col("payload"), "content_extraction")["items"].alias("_items")).where(valid_items(F.col("_items"), "unit_id"))
    by_unit = items.select(document, F.explode("_items").alias("_i")).groupBy(document, F.col("_i.unit_id").alias("_unit")).agg(F.first("_i").alias("_i"))
    unit = F.coalesce(F.nullif(F.col("chunk_id"), F.lit("")), F.col("page_number").cast("string"))
    none = F.array().cast("array<string>")
    joined = pages.drop("keywords", "entities").withColumn("_unit", unit).join(by_unit, [document, "_unit"], "left")
    return joined.withColumns({"keywords": F.coalesce("_i.keywords", none), "entities": F.coalesce("_i.entities", none)}).drop("_unit", "_i")


def document_metadata(versions: DataFrame, said: DataFrame, key: str = "id") -> DataFrame:
    """(key, title, language, structure_type, has_toc): a document's metadata from the answers (key, answer); workbooks are sheet_based whatever is said, and
    the file's name stands for a blank title. Documents without an answer have no structure."""
    joined = versions.select(key, "filename", "filetype").join(said.select(key, "answer"), key, "left")
    return joined.select(
        key,
        F.coalesce(F.nullif(F.trim("answer.title"), F.lit("")), F.col("filename")).alias("title"),
        F.coalesce("answer.language", F.lit("")).alias("language"),
        F.when(F.lower("filetype") == "xlsx", "sheet_based").otherwise(F.coalesce("answer.structure_type", F.lit(""))).alias("structure_type"),
        F.coalesce("answer.has_toc", F.lit(False)).alias("has_toc"),
    )


def toc_entries(sections: DataFrame, document: str = "document_version_id") -> DataFrame:
    """(document, toc): the sections in order as an array of (name, page_number, summary)."""
    entry = F.struct(F.col("page_start").alias("_p"), F.col("section_id").try_cast("int").alias("_n"), F.struct(F.col("title").alias("name"), F.col("page_start").alias("page_number"), F.coalesce("summary", F.lit("")).alias("summary")).alias("e"))
    return sections.groupBy(document).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias("toc"))


def to_summarise(sections: DataFrame) -> DataFrame:
    """Sections with ``turn``: primaries first, then subsections that have no summary yet; those that have one are left out."""
    first = F.col("level") == "section"
    return sections.where(first | (F.coalesce("summary", F.lit("")) == "")).withColumn("turn", F.when(first, 1).otherwise(2))


def large_subsections(sections: DataFrame, pages: DataFrame, limit: int = 15_000, document: str = "document_version_id") -> DataFrame:
    """(document, parent_section_id, section_id, page_number): the pages of sections beyond the limit as their subsections ``id.1``, ``id.2``, in page order."""
    owned = pages_in_sections(pages, sections, document).where(F.col("section_id").isNotNull())
    large = owned.groupBy(document, "section_id").agg(F.sum(F.coalesce("token_count", F.lit(0))).alias("_t")).where(F.col("_t") > limit)
    own_pages = owned.select(document, "section_id", "page_number").distinct().join(large.select(document, "section_id"), [document, "section_id"])
    no = F.row_number().over(Window.partitionBy(document, "section_id").orderBy("page_number"))
    return own_pages.select(document, F.col("section_id").alias("parent_section_id"), F.concat_ws(".", "section_id", no.cast("string")).alias("section_id"), "page_number")


def padded_box(x1: Column, y1: Column, x2: Column, y2: Column, padding: float = 0.025) -> Column:
    """A region's corners moved outwards by a part of the page, inside the page; NULL if the box is not valid."""
    one, zero = F.lit(1.0), F.lit(0.0)
    box = F.struct(F.greatest(zero, x1 - padding).alias("x1"), F.greatest(zero, y1 - padding).alias("y1"), F.least(one, x2 + padding).alias("x2"), F.least(one, y2 + padding).alias("y2"))
    return F.when(valid_box(x1, y1, x2, y2), box)


def page_with_regions(text: Column, regions: Column) -> Column:
    """A page's text and, under headings of their own, what was read in its regions (title, content); blank contents are left out."""
    told = F.transform(F.filter(F.coalesce(regions, F.array()), lambda r: F.coalesce(r["content"], F.lit("")) != ""), lambda r: F.concat(F.lit("## "), F.coalesce(r["title"], F.lit("Region")), F.lit("\n"), r["content"]))
    return F.concat_ws("\n\n", F.nullif(F.coalesce(text, F.lit("")), F.lit("")), told)
