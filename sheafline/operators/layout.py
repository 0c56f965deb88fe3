"""Layout: blocks merged into paragraphs, reading order, visual rows, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.functions import geometry as G
from sheafline.functions import text as X
from sheafline.plans import schema as S


def block_role(label: Column) -> Column:
    """The role of an engine's label; a label without one is ``other``."""
    roles = F.create_map(*[F.lit(x) for pair in S.BLOCK_TYPES.items() for x in pair])
    return F.coalesce(roles[label], F.lit("other"))


def islands(rows: DataFrame, keys: list[str], order: list[str], breaks: Column, name: str = "island") -> DataFrame:
    """Number the runs of rows between those that break them; a breaker opens a run of its own number."""
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.when(breaks, 1).otherwise(0)).over(by))


def merge_blocks(blocks: DataFrame, key: str = "document_id") -> DataFrame:
    """Consecutive ``text`` blocks of a document become one paragraph: texts that aren't empty joined by a space, the box
    around them, the first one's page and order, no level. Any other type stands alone and breaks a run.

    blocks: (key, page, order, type, text, bbox, level), read in page, top, left, order.
    """
    plain = F.col("type") == "text"
    keyed = blocks.withColumn("_top", G.top_key(F.col("bbox"))).withColumn("_left", G.left_key(F.col("bbox")))
    order = ["page", "_top", "_left", "order"]
    runs = islands(keyed, [key], order, ~plain).withColumn("_plain", plain)
    place = F.struct(*order)
    first = lambda c: F.min_by(c, place)
    merged = runs.groupBy(key, "island", "_plain").agg(
        first("page").alias("page"),
        first("order").alias("order"),
        first("type").alias("_type"),
        F.array_join(
            F.filter(F.transform(F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda s: s["text"]), lambda t: t != ""), " "
        ).alias("text"),
        G.union(F.col("bbox")).alias("_bbox"),
        first("bbox").alias("_own"),
        first("level").alias("_level"),
    )
    return merged.select(
        key,
        "page",
        "order",
        F.when(F.col("_plain"), "paragraph").otherwise(F.col("_type")).alias("type"),
        "text",
        F.when(F.col("_plain"), F.col("_bbox")).otherwise(F.col("_own")).alias("bbox"),
        F.when(~F.col("_plain"), F.col("_level")).alias("level"),
    )


def reading_order(blocks: DataFrame, tables: DataFrame, key: str = "document_id", by_geometry: bool = True) -> DataFrame:
    """(key, kind, id, position, text, bbox): merged blocks and tables numbered each in its own order
    (block_001, table_001), then interleaved by top and left, ties by number with blocks first.

    tables: (key, order, markdown, bbox). Without geometry, order alone decides.
    """
    drop = lambda df: df if by_geometry else df.withColumn("bbox", F.expr(f"cast(null as {S.BOX})"))
    numbered = []
    for kind, rows in (("block", merge_blocks(drop(blocks), key)), ("table", drop(tables).withColumn("page", F.lit(0)))):
        box = F.col("bbox")
        by = Window.partitionBy(key).orderBy(*G.reading_key(F.col("page"), box, F.col("order")))
        text = F.col("text" if kind == "block" else "markdown")
        numbered.append(
            rows.withColumn("n", F.row_number().over(by)).select(
                key, F.lit(kind).alias("kind"), "n", X.numbered(kind, F.col("n")).alias("id"), text.alias("text"), "bbox"
            )
        )
    both = numbered[0].unionByName(numbered[1])
    by = Window.partitionBy(key).orderBy(G.top_key(F.col("bbox")), G.left_key(F.col("bbox")), "n", "kind")
    return both.withColumn("position", F.row_number().over(by)).select(key, "kind", "id", "position", "text", "bbox")


def visual_rows(items: DataFrame, keys: list[str]) -> DataFrame:
    """Items of a page grouped into the rows that a reader sees: (keys, item, row, place).

    items: (keys, item, l, t, r, b, order, whole). From the top, an item joins the first row that it
    overlaps by more than half of the shorter extent, and the row grows by it; a whole item (a table)
    stands alone. Each placement depends on the ones before, so a page, which is small, is one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("_items").to_pylist()
            counts = [len(page) for page in pages]
            back = pa.array([i for i, n in enumerate(counts) for _ in range(n)], pa.int64())
            places = [place for page in pages for place in _row_places(page)]
            kind = batch.schema.field("_items").type.value_type.field("item").type
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k).take(back) for k in keys),
                    pa.array([i["item"] for page in pages for i in page], kind),
                    pa.array([row for row, _ in places], pa.int64()),
                    pa.array([place for _, place in places], pa.int64()),
                ],
                [*keys, "item", "row", "place"],
            )

    page = F.array_sort(F.collect_list(F.struct("t", "l", "order", "item", "b", "whole")))
    pages = items.groupBy(*keys).agg(page.alias("_items"))
    kinds = {f.name: f.dataType.simpleString() for f in items.schema}
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "item"])
    return pages.mapInArrow(run, f"{schema}, row long, place long")


def _row_places(page: list[dict]) -> list[list[int]]:
    """[row, place] of each item of a page, given by top, left and order."""
    spans: list[list] = []  # top, bottom, whole, left of the first item, items
    for i, item in enumerate(page):
        top, bottom, home = item["t"], item["b"], None
        if not item["whole"]:
            for span in spans:
                shorter = min(span[1] - span[0], bottom - top)
                if not span[2] and 0 < shorter < 2 * (min(span[1], bottom) - max(span[0], top)):
                    home = span
                    break
        if home is None:
            spans.append([top, bottom, item["whole"], item["l"], [i]])
        else:
            home[0], home[1] = min(home[0], top), max(home[1], bottom)
            home[4].append(i)
    spans.sort(key=lambda s: (s[0], s[3]))
    found = [[0, 0]] * len(page)
    for n, span in enumerate(spans, 1):
        inside = sorted(span[4], key=lambda i: (page[i]["l"], page[i]["order"]))
        for place, i in enumerate(inside, 1):
            found[i] = [n, place]
    return found


def render_reading(items: DataFrame, keys: list[str], separator: str = "   ") -> DataFrame:
    """(keys, reading): a line a visual row with a blank line between, items of a row by the separator.
    A page on which any box is null is read in the engine's order, an item a line.

    items: (keys, item, text, bbox, order, whole); items without text are left out.
    """
    some = items.where(F.length("text") > 0)
    flat = some.groupBy(*keys).agg(F.bool_or(F.col("bbox").isNull()).alias("_flat"))
    marked = some.join(flat, keys)
    placed = marked.where(~F.col("_flat"))
    boxed = placed.select(*keys, "item", "bbox.*", "order", "whole")
    rows = visual_rows(boxed, keys).join(placed.select(*keys, "item", "text"), [*keys, "item"])
    ordered = lambda sort, joined: F.array_join(F.transform(F.array_sort(F.collect_list(sort)), lambda s: s["text"]), joined)
    lines = rows.groupBy(*keys, "row").agg(ordered(F.struct("place", "text"), separator).alias("text"))
    pages = lines.groupBy(*keys).agg(ordered(F.struct("row", "text"), "\n\n").alias("reading"))
    plain = marked.where("_flat").groupBy(*keys).agg(ordered(F.struct("order", "text"), "\n\n").alias("reading"))
    return pages.unionByName(plain)


def normalized_grid(cells: Column) -> Column:
    """array<array<string>>: cells stripped, short rows filled up to the widest."""
    width = F.array_max(F.transform(cells, F.size))
    bare = lambda row: F.transform(row, lambda c: F.coalesce(X.strip(c), F.lit("")))
    return F.transform(cells, lambda row: F.concat(bare(row), F.array_repeat(F.lit(""), width - F.size(row))))


def grid_of(cells: DataFrame, key: str) -> DataFrame:
    """(key, cells): a grid from placed cells (key, n_rows, n_cols, row, col, pos, text); a later cell of
    a place replaces an earlier one, and cells outside of the grid are dropped."""
    inside = cells.where("row between 0 and n_rows - 1 and col between 0 and n_cols - 1")
    last = inside.groupBy(key, "row", "col").agg(F.max_by("text", "pos").alias("text"))
    held = last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.struct("row", "col"), F.coalesce("text", F.lit(""))))).alias("_at"))
    shape = cells.groupBy(key).agg(F.max("n_rows").alias("_rows"), F.max("n_cols").alias("_cols"))
    cell = lambda r, c: F.coalesce(F.element_at("_at", F.struct(r.alias("row"), c.alias("col"))), F.lit(""))
    line = lambda r: F.transform(F.sequence(F.lit(0), F.col("_cols") - 1), lambda c: cell(r, c))
    grid = F.transform(F.sequence(F.lit(0), F.col("_rows") - 1), line)
    return shape.join(held, key, "left").select(key, F.when((F.col("_rows") > 0) & (F.col("_cols") > 0), grid).alias("cells"))


def table_markdown(cells: Column) -> Column:
    """A grid as a Markdown table whose first row is the head; an empty grid is an empty text."""
    line = lambda row: F.concat(F.lit("| "), F.array_join(row, " | "), F.lit(" |"))
    rule = line(F.transform(cells[0], lambda _: F.lit("---")))
    lines = F.concat(F.array(line(cells[0]), rule), F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), line))
    return F.when(F.size(cells) > 0, F.array_join(lines, "\n")).otherwise("")


def ocr_metrics(text: Column, block_types: Column, tables: Column, width: Column, height: Column) -> Column:
    """struct of an extraction's measurements; line breaks count as characters here. A page without area
    is an error."""
    of = lambda kind: F.size(F.filter(block_types, lambda t: t == kind)).cast("long")
    characters = F.length(text).cast("long")
    density = F.when(width * height > 0, characters / (width * height)).otherwise(F.raise_error(F.lit("LAYOUT_ERROR: page has no area")))
    structural = F.exists(block_types, lambda t: t.isin(*S.STRUCTURAL_BLOCKS))
    return F.struct(
        characters.alias("characters"),
        X.word_count(text).alias("words"),
        F.size(block_types).cast("long").alias("blocks"),
        tables.cast("long").alias("tables"),
        of("paragraph").alias("paragraphs"),
        density.alias("text_density"),
        X.is_blank(text).alias("empty"),
        ((tables > 0) | structural).alias("structure_detected"),
    )


def ocr_state(status: Column, error_type: Column, produced: Column, missing: Column, errors: Column, empty: Column, characters: Column) -> Column:
    """The validation state of an extraction; produced: it reported artifacts and measurements."""
    return (
        F.when(status == "failed", F.when(error_type == "EXPORT_ERROR", "PARSE_ERROR").otherwise("ERROR"))
        .when(~produced, "ERROR")
        .when((missing > 0) | (errors > 0), "INCOMPLETE")
        .when(empty, "EMPTY")
        .when(characters < S.LOW_CONTENT_CHARS, "LOW_CONTENT")
        .otherwise("VALID")
    )


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tsv_flows(report: Column, boxes: bool = True) -> Column:
    """array<struct<block int, text string, bbox>>: the blocks of a page's text report, in the row; without
    ``boxes`` only their texts are read.

    A report has tab-separated rows; level 3 opens a block and gives its box, level 4 closes a line, level 5
    adds the word in column 11. Rows under 12 columns count for nothing; words are joined by a space, lines
    by a line break; blocks without words are left out and take no number.
    """
    # Searches for single characters only: patterns, and a split of each row into its columns, cost several times that.
    upto = lambda row, columns: F.substring_index(row, "\t", columns)
    level = lambda row, n: (F.trim(upto(row, 1)) == n) & (F.octet_length(upto(row, 11)) < F.octet_length(row))

    def element(row: Column) -> Column:
        word = F.nullif(F.substring_index(upto(row, 12), "\t", -1), F.lit(""))
        return F.when(level(row, "5"), word).when(level(row, "3"), "\t").when(level(row, "4"), "\n")

    def box(cells: Column) -> Column:
        number = lambda i: cells[i].try_cast("double")
        return G.sized_box(number(6), number(7), number(8), number(9))

    def flows(joined: Column) -> Column:
        # Words stand between CRs, which they don't hold; stripped one by one only where any has white space.
        spaced = F.lit(False)
        for c in set(X.SPACES) - set("\t\n\r"):
            spaced = F.contains(joined, F.lit(c)) | spaced
        stripped = lambda line: F.array_join(F.filter(F.transform(F.split(line, "\r"), X.strip), lambda w: w != ""), " ")
        plain = lambda line: F.trim(F.replace(line, F.lit("\r"), F.lit(" ")))

        def parted(line: Callable[[Column], Column]) -> Column:
            flow = lambda part: F.array_join(F.filter(F.transform(F.split(part, "\n"), line), lambda t: t != ""), "\n")
            return F.transform(F.split(joined, "\t"), lambda part, i: F.struct(i.alias("nth"), flow(part).alias("text")))

        return F.filter(F.when(spaced, parted(stripped)).otherwise(parted(plain)), lambda f: f["text"] != "")

    def blocks(rows: Column) -> Column:
        kept = _let(F.array_join(F.transform(rows, element), "\r"), flows)
        if not boxes:
            return F.transform(kept, lambda f, i: F.struct((i + 1).cast("int").alias("block"), f["text"].alias("text")))
        heads = F.filter(rows, lambda row: F.startswith(F.ltrim(row), F.lit("3")) & level(row, "3"))
        # What stands before the first row of level 3 has no box.
        return _let(
            F.transform(heads, lambda row: _let(F.split(row, "\t"), box)),
            lambda found: F.transform(kept, lambda f, i: F.struct((i + 1).cast("int").alias("block"), f["text"].alias("text"), F.get(found, f["nth"] - 1).alias("bbox"))),
        )

    return _let(F.split(X.unify_lines(report), "\n"), blocks)


def tsv_blocks(reports: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block, block_id, text, bbox): the blocks of text reports (keys, report), without a shuffle."""
    told = reports.select(*keys, F.inline(tsv_flows(F.col("report"))))
    return told.select(*keys, "block", X.numbered("block", F.col("block")).alias("block_id"), "text", "bbox")


def tsv_text(reports: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text, blocks): the text of the pages of text reports, a line a line of the page, and the number
    of its blocks; pages without words have none."""
    flows = reports.select(*keys, tsv_flows(F.col("report"), boxes=False).alias("_flows"))
    text = F.array_join(F.transform("_flows", lambda f: f["text"]), "\n")
    return flows.select(*keys, text.alias("text"), F.size("_flows").alias("blocks"))


def image_report(reports: DataFrame, keys: list[str], page: str) -> DataFrame:
    """(keys, pos, width, height, color, bpc, encoding, object): the list of embedded images of pages;
    rows with fewer than 13 columns or of another page are left out."""
    rows = reports.select(*keys, F.col(page).alias("_page"), F.posexplode(F.split("report", "\n")).alias("_line", "line")).withColumn(
        "c", F.split(F.trim("line"), r"\s+")
    )
    number = lambda i: F.expr(f"try_cast(c[{i}] as int)")
    good = rows.where((F.size("c") >= 13) & (number(0) == F.col("_page")) & (F.col("c")[2] == "image"))
    by = Window.partitionBy(*keys).orderBy("_line")
    return good.withColumn("pos", F.row_number().over(by)).select(
        *keys, "pos", number(3).alias("width"), number(4).alias("height"), F.col("c")[5].alias("color"), F.col("c")[7].alias("bpc"),
        F.col("c")[8].alias("encoding"), F.concat_ws(" ", F.col("c")[10], F.col("c")[11]).alias("object"),
    )


def match_images(report: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Reported images zipped with the files that were written, by position; count_matches tells whether
    a page reported as many as it wrote. files: (keys, path); a file's trailing number is its order."""
    by = Window.partitionBy(*keys).orderBy(X.trailing_number(F.col("path")), "path")
    zipped = report.join(files.withColumn("pos", F.row_number().over(by)), [*keys, "pos"], "full")
    whole = Window.partitionBy(*keys)
    matches = F.min(F.when(F.col("path").isNotNull() & F.col("width").isNotNull(), 1).otherwise(0)).over(whole) == 1
    return zipped.withColumn("count_matches", matches).withColumn("image_id", X.numbered("image", F.col("pos")))


def text_regions(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Regions numbered region_001 from the top and the left. boxes: (keys, bbox, text_coverage)."""
    by = Window.partitionBy(*keys).orderBy(F.col("bbox.t"), F.col("bbox.l"))
    return boxes.withColumn("region_id", X.numbered("region", F.row_number().over(by)))


def conversion_failure(status: Column) -> Column:
    """struct<type, recoverable> of what an engine's conversion came to; null for success. A conversion that
    is partial goes on; one that failed, or says what isn't known, ends."""
    told = lambda kind, goes_on: F.struct(F.lit(kind).alias("type"), F.lit(goes_on).alias("recoverable"))
    return F.when(status == "partial_success", told("OCR_ERROR", True)).when(status == "failure", told("OCR_ERROR", False)).when(status.isNull() | (status != "success"), told("ENGINE_ERROR", False))


def declared_artifacts(text: Column, markdown: Column, document: Column, tables_dir: Column, tables: Column) -> Column:
    """The files that a good extraction has published, in that order; a folder of tables only if it found any."""
    return F.filter(F.array(text, markdown, document, F.when(tables > 0, tables_dir)), lambda p: p.isNotNull())


def ocr_metadata(path: Column, engine_version: Column, options: Column, metrics: Column, validation: Column, seconds: Column, steps: Column) -> Column:
    """struct: the record of where an extraction comes from; the engine is stated, never chosen."""
    name, version = S.PROCESSORS["OCR"]
    return F.struct(
        F.lit(S.OCR_ENGINE).alias("engine"), engine_version.alias("engine_version"), F.lit(name).alias("processor"), F.lit(version).alias("processor_version"), options.alias("options"),
        path.alias("input"), metrics.alias("metrics"), validation.alias("validation"), seconds.alias("seconds"), steps.alias("transformations"),
    )
