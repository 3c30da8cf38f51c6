"""Joins by place and by order: rows and columns of recognised boxes, boxes outside tables, and tables zipped by position."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.dedup import stored
from quern.operators.tables import iou

#: How far, in pixels, the centre of a box may be from its row's first one, and from its column.
ROW_REACH, COLUMN_REACH = 15.0, 20.0


def anchors(values: Column, reach: float) -> Column:
    """Of an array of numbers, in order, those that are more than reach from every one kept before."""
    return F.aggregate(values, F.array().cast("array<double>"), lambda kept, x: F.when(F.exists(kept, lambda k: F.abs(x - k) <= reach), kept).otherwise(F.array_append(kept, x)))


def row_anchors(values: Column, reach: float) -> Column:
    """Of an ascending array of numbers, those that are more than reach above the last one kept."""
    return F.aggregate(values, F.array().cast("array<double>"), lambda kept, x: F.when((F.size(kept) > 0) & (x - F.try_element_at(kept, F.lit(-1)) <= reach), kept).otherwise(F.array_append(kept, x)))


def nearest(x: Column, columns: Column, reach: float) -> Column:
    """The place (0 first) of the first of an array of numbers within reach of x, else of the nearest, the first of equals."""
    indexed = F.transform(columns, lambda c, i: F.struct(F.abs(c - x).alias("d"), i.alias("i")))
    return F.coalesce(F.try_element_at(F.filter(indexed, lambda e: e["d"] <= reach), F.lit(1))["i"], F.array_min(indexed)["i"])


def grid(boxes: DataFrame) -> DataFrame:
    """boxes (id, page, x, y: centres) with row and col: rows begin where y is beyond the reach of the row's first, columns are the distinct x beyond each other's reach, taken from left to right."""
    page = boxes.groupBy("id", "page").agg(F.sort_array(F.collect_list("y")).alias("ys"), F.sort_array(F.collect_list("x")).alias("xs"))  # a page's boxes
    page = page.select("id", "page", row_anchors(F.col("ys"), ROW_REACH).alias("rows"), anchors(F.col("xs"), COLUMN_REACH).alias("columns"))
    placed = boxes.join(page, ["id", "page"])
    row = F.size(F.filter("rows", lambda r: r <= F.col("y"))) - 1
    return placed.withColumn("row", row).withColumn("col", nearest(F.col("x"), F.col("columns"), COLUMN_REACH)).drop("rows", "columns")


def outside(boxes: DataFrame, tables: DataFrame) -> DataFrame:
    """The boxes (id, page, x, y) whose centre is in no table (id, page, x_min, y_min, x_max, y_max) of their page."""
    t = tables.select(F.col("id").alias("tid"), F.col("page").alias("tpage"), "x_min", "y_min", "x_max", "y_max")
    inside = (F.col("id") == F.col("tid")) & (F.col("page") == F.col("tpage")) & F.col("x").between(F.col("x_min"), F.col("x_max")) & F.col("y").between(F.col("y_min"), F.col("y_max"))
    return boxes.join(t, inside, "left_anti")


def zipped(a: DataFrame, b: DataFrame, keys: list[str], order_a: str, order_b: str) -> DataFrame:
    """Within keys, the first of a with the first of b by their orders, the second with the second, as far as both go; of clashing names b's have a leading b_."""
    number = lambda d, order: d.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    clash = {c: f"b_{c}" for c in b.columns if c in a.columns and c not in keys}
    return number(a, order_a).join(number(b, order_b).withColumnsRenamed(clash), [*keys, "position"])


#: Edge of the finest tiles, in the boxes' unit.
TILE = 32.0


def edges(box: str) -> list[Column]:
    """Left, top, right, bottom of a box."""
    return [F.get(F.col(box), F.lit(i)).cast("double") for i in range(4)]


def has_area(box: str) -> Column:
    """Whether a box has four finite edges in order, and an area."""
    x0, y0, x1, y1 = edges(box)
    finite = F.forall(F.col(box), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    return F.coalesce((F.size(box) == 4) & finite & (x1 > x0) & (y1 > y0), F.lit(False))


def tile_level(box: str, tile: float) -> Column:
    """How often the finest tile's edge must double until the box is no larger, so that it lies in four tiles at most."""
    x0, y0, x1, y1 = edges(box)
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(x1 - x0, y1 - y0) / tile))).cast("int")


def tiled(boxes: DataFrame, box: str, level: str, levels: list[int], tile: float) -> DataFrame:
    """A row for each tile that a box touches, at its own level and at each coarser one of `levels`: at, tx, ty."""
    x0, y0, x1, y1 = edges(box)
    span = lambda a, b: F.sequence(F.floor(a / F.col("edge")), F.floor(b / F.col("edge")))
    at = boxes.withColumn("at", F.explode(F.array(*map(F.lit, levels)))).filter(F.col("at") >= F.col(level)).withColumn("edge", F.lit(tile) * F.pow(F.lit(2.0), "at"))
    return at.withColumn("tx", F.explode(span(x0, x1))).withColumn("ty", F.explode(span(y0, y1)))


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], box_a: str = "box_a", box_b: str = "box_b", tile: float = TILE) -> DataFrame:
    """The pairs of boxes of a and b that share an area, within equal keys; all other columns need names of their own.

    An equi-join of tiles. A pair meets at the coarser of its two levels, where each box lies in four tiles at most, however
    large it is, and counts in that tile only that holds the corner where the shared area begins. A page with most boxes is
    dealt out by tiles.
    """
    a, b = (d.filter(has_area(x)).withColumn(level, tile_level(x, tile)) for d, x, level in ((a, box_a, "level_a"), (b, box_b, "level_b")))
    levels = sorted(r[0] for r in a.select("level_a").unionByName(b.select(F.col("level_b").alias("level_a"))).distinct().collect())  # as many as sizes double
    if not levels:
        levels = [0]
    met = tiled(a, box_a, "level_a", levels, tile).join(tiled(b, box_b, "level_b", levels, tile).drop("edge"), [*keys, "at", "tx", "ty"])
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = edges(box_a), edges(box_b)
    left, top = F.greatest(ax0, bx0), F.greatest(ay0, by0)
    shared = (left < F.least(ax1, bx1)) & (top < F.least(ay1, by1))
    here = (F.floor(left / F.col("edge")) == F.col("tx")) & (F.floor(top / F.col("edge")) == F.col("ty"))
    return met.filter((F.col("at") == F.greatest("level_a", "level_b")) & shared & here).drop("at", "tx", "ty", "edge", "level_a", "level_b")


def candidates(cells: DataFrame, lines: DataFrame, keys: list[str], least: float, tile: float) -> DataFrame:
    """keys, cell_box, line_box, iou of the distinct boxes of cells (bbox) and lines (bbox) that overlap from `least` on."""
    pairs = overlaps(cells.select(*keys, F.col("bbox").alias("box_a")).distinct(), lines.select(*keys, F.col("bbox").alias("box_b")).distinct(), keys, tile=tile)
    return pairs.withColumn("iou", iou("box_a", "box_b")).filter(F.col("iou") >= least).withColumnsRenamed({"box_a": "cell_box", "box_b": "line_box"})


#: Pairs of boxes that a page has at most to be matched as one row; larger pages are dealt out by tiles.
SMALL = 4096


def large_pages(cells: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of pages with more than SMALL pairs, or boxes of either kind."""
    n = cells.groupBy(*keys).agg(F.count("*").alias("a")).join(lines.groupBy(*keys).agg(F.count("*").alias("b")), keys, "full")
    return stored(n.filter(F.coalesce("a", F.lit(1)) * F.coalesce("b", F.lit(1)) > SMALL).select(*keys), "large")


def wishes(cells: DataFrame, lines: DataFrame, keys: list[str], least: float) -> DataFrame:
    """cells with wish: the lines of its page that overlap each from `least` on, as minus (the negative iou) and ord, the best first. For pages that are small."""
    held = lines.filter(has_area("bbox")).groupBy(*keys).agg(F.collect_list(F.struct(F.col("bbox").alias("line"), "ord")).alias("wish"))  # SMALL lines at most
    scored = F.transform("wish", lambda x: F.struct((-iou("bbox", x["line"])).alias("minus"), x["ord"].alias("ord")))
    near = F.sort_array(F.filter(scored, lambda x: (x["minus"] <= -least) & (x["minus"] < 0)))
    return cells.join(held, keys, "left").withColumn("wish", F.when(has_area("bbox"), near))


def by_size(cells: DataFrame, lines: DataFrame, keys: list[str], small: Callable, large: Callable) -> DataFrame:
    """What small(cells, lines) gives for small pages and large(cells, lines) for the others."""
    pages = large_pages(cells, lines, keys)
    if not pages.limit(1).count():
        return small(cells, lines)
    parts = [f(*(d.join(pages, keys, how) for d in (cells, lines))) for f, how in ((small, "left_anti"), (large, "left_semi"))]
    return parts[0].unionByName(parts[1])


def best_match(cells: DataFrame, lines: DataFrame, keys: list[str] | None = None, least: float = 0.3, tile: float = TILE) -> DataFrame:
    """cells (keys, cell, bbox) with ord and iou of the line (keys, ord, bbox) that overlaps each most, from `least` on, the first of equals; null without any. One line may serve many cells."""
    keys = keys or ["id", "page"]
    first = F.get("wish", F.lit(0))
    small = lambda c, t: wishes(c, t, keys, least).select(*cells.columns, first["ord"].alias("ord"), (-first["minus"]).alias("iou"))
    return by_size(cells, lines, keys, small, lambda c, t: best_of_tiles(c, t, keys, least, tile))


def best_of_tiles(cells: DataFrame, lines: DataFrame, keys: list[str], least: float, tile: float) -> DataFrame:
    """best_match() for pages of any size. Equal boxes are joined once."""
    first = lines.groupBy(*keys, F.col("bbox").alias("line_box")).agg(F.min("ord").alias("ord"))
    scored = candidates(cells, lines, keys, least, tile).join(first, [*keys, "line_box"])
    best = scored.groupBy(*keys, F.col("cell_box").alias("bbox")).agg(F.max_by(F.struct("ord", "iou"), F.struct("iou", -F.col("ord"))).alias("x"))
    return cells.join(best, [*keys, "bbox"], "left").select(*cells.columns, "x.ord", "x.iou")


def exclusive_match(cells: DataFrame, lines: DataFrame, keys: list[str] | None = None, least: float = 0.3, tile: float = TILE) -> DataFrame:
    """keys, cell, ord, iou: each line (keys, ord, bbox) used once, as if the cells (keys, cell, bbox) chose in the order of `cell` the line not yet taken that overlaps most, the first of equals.

    A small page is one row, whose cells choose in turn; larger ones are matched in rounds. cell and ord are distinct within keys.
    """
    keys = keys or ["id", "page"]
    cell, ord = (d.schema[c].dataType.simpleString() for d, c in ((cells, "cell"), (lines, "ord")))
    start = F.struct(F.array().cast(f"array<{ord}>").alias("taken"), F.array().cast(f"array<struct<cell:{cell},ord:{ord},iou:double>>").alias("made"))

    def choose(state: Column, x: Column) -> Column:
        own = F.get(F.filter(x["wish"], lambda w: ~F.array_contains(state["taken"], w["ord"])), F.lit(0))
        made = F.struct(x["cell"].alias("cell"), own["ord"].alias("ord"), (-own["minus"]).alias("iou"))
        return F.when(own.isNull(), state).otherwise(F.struct(F.array_append(state["taken"], own["ord"]).alias("taken"), F.array_append(state["made"], made).alias("made")))

    def small(c: DataFrame, t: DataFrame) -> DataFrame:
        page = wishes(c, t, keys, least).filter(F.size("wish") > 0).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("cell", "wish"))).alias("all"))  # a small page's
        return page.select(*keys, F.inline(F.aggregate("all", start, choose)["made"]))

    return by_size(cells, lines, keys, small, lambda c, t: exclusive_in_rounds(c, t, keys, least, tile))


def exclusive_in_rounds(cells: DataFrame, lines: DataFrame, keys: list[str], least: float, tile: float) -> DataFrame:
    """exclusive_match() for pages of any size.

    All cells choose at once; a line that is chosen is lost to every later cell than the first that chose it, as that one or
    an earlier one will have it. Those edges go, and the cells that lost theirs choose again, until nothing changes: what
    choosing in turn gives. Each round's edges are written to the shared folder.
    """
    boxes = candidates(cells, lines, keys, least, tile)
    edge = boxes.join(cells.select(*keys, "cell", F.col("bbox").alias("cell_box")), [*keys, "cell_box"]).join(lines.select(*keys, "ord", F.col("bbox").alias("line_box")), [*keys, "line_box"])
    edge = stored(edge.select(*keys, "cell", "ord", "iou"), "matching")
    n = edge.count()
    while True:
        choice = edge.groupBy(*keys, "cell").agg(F.max_by(F.struct("ord", "iou"), F.struct("iou", -F.col("ord"))).alias("x")).select(*keys, "cell", "x.ord", "x.iou")
        first = choice.groupBy(*keys, "ord").agg(F.min("cell").alias("first"))
        edge = stored(edge.join(first, [*keys, "ord"], "left").filter(F.col("first").isNull() | (F.col("cell") <= F.col("first"))).drop("first"), "matching")
        if n == (n := edge.count()):
            return edge.groupBy(*keys, "cell").agg(F.max_by(F.struct("ord", "iou"), F.struct("iou", -F.col("ord"))).alias("x")).select(*keys, "cell", "x.ord", "x.iou")


def outside_boxes(points: DataFrame, areas: DataFrame, keys: list[str] | None = None, tile: float = TILE) -> DataFrame:
    """The points (keys, x, y) that no area (keys, x_min, y_min, x_max, y_max) holds, edges included: an anti-join of tiles. A point lies in one tile of each level; areas lie in four tiles at most of their own level."""
    keys = keys or ["id", "page"]
    t = areas.select(*keys, F.array(*(F.col(c).cast("double") for c in ("x_min", "y_min", "x_max", "y_max"))).alias("area"))
    x0, y0, x1, y1 = edges("area")
    t = t.filter((x1 >= x0) & (y1 >= y0)).withColumn("level", tile_level("area", tile))
    levels = sorted(r[0] for r in t.select("level").distinct().collect())
    if not levels:
        return points
    t = stored(tiled(t, "area", "level", levels, tile).filter("at = level").select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("at").alias("__at"), F.col("tx").alias("__tx"), F.col("ty").alias("__ty"), "area"), "areas")
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    for level in levels:  # a join for each doubling of sizes, so that no point is copied
        e = tile * 2.0**level
        same = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.floor(x / e) == F.col("__tx"), F.floor(y / e) == F.col("__ty")]
        held = (x >= edges("area")[0]) & (y >= edges("area")[1]) & (x <= edges("area")[2]) & (y <= edges("area")[3])
        points = points.join(t.filter(F.col("__at") == level), [*same, held], "left_anti")
    return points


def polygon_box(points: Column) -> Column:
    """Left, top, right, bottom of a polygon, an array of points (arrays of x and y)."""
    of = lambda f, i: f(F.transform(points, lambda p: F.get(p, F.lit(i)).cast("double")))
    return F.array(of(F.array_min, 0), of(F.array_min, 1), of(F.array_max, 0), of(F.array_max, 1))


def to_page(box: str, width: Column, height: Column, page: str, rotation: Column) -> Column:
    """A box in pixels of a page rendered width by height as a box on the page (left, bottom, right, top), whose origin is below and which was turned by 0, 90, 180 or 270 degrees; other turns count as none."""
    (x0, y0, x1, y1), (left, bottom, right, top) = edges(box), edges(page)
    w, h = right - left, top - bottom
    aside = rotation.isin(90, 270)
    scale_x = F.when(aside, h).otherwise(w) / F.greatest(F.lit(1), width)
    scale_y = F.when(aside, w).otherwise(h) / F.greatest(F.lit(1), height)

    def corner(px: Column, py: Column) -> tuple[Column, Column]:
        x, y = px * scale_x, (height - py) * scale_y
        turned = lambda a, b, c, d: F.when(rotation == 90, b).when(rotation == 180, c).when(rotation == 270, d).otherwise(a)
        return left + turned(x, w - y, w - x, y), bottom + turned(y, x, h - y, h - x)

    corners = [corner(px, py) for px in (x0, x1) for py in (y0, y1)]
    return F.array(F.least(*(c[0] for c in corners)), F.least(*(c[1] for c in corners)), F.greatest(*(c[0] for c in corners)), F.greatest(*(c[1] for c in corners)))


# What a page of recognised lines needs to be a table, and to pass, and how long a title is.
LEAST_CELLS, PASSING, TITLE = 4, 0.6, (3, 99)


def page_tables(lines: DataFrame) -> DataFrame:
    """id, page, n_rows, n_cols, n_cells, bbox, title, confidence, passed of the pages of lines (id, page, text, confidence, bbox) that are a table: two rows and columns at least by grid(), and LEAST_CELLS cells. The title is the leftmost text of the first row, if it is neither short nor long; passed asks for a mean confidence of PASSING."""
    x0, y0, x1, y1 = edges("bbox")
    g = grid(lines.withColumns({"x": (x0 + x1) / 2, "y": (y0 + y1) / 2}))
    t = g.groupBy("id", "page").agg(
        (F.max("row") + 1).alias("n_rows"), F.count("*").alias("n_cells"), F.array(F.min(x0), F.min(y0), F.max(x1), F.max(y1)).alias("bbox"),
        F.min_by("text", F.struct("row", "x", "y")).alias("title"), F.avg("confidence").alias("mean"),
    )
    columns = lines.select("id", "page", ((x0 + x1) / 2).alias("x")).groupBy("id", "page").agg(F.size(anchors(F.sort_array(F.collect_list("x")), COLUMN_REACH)).alias("n_cols"))  # a page's boxes
    t = t.join(columns, ["id", "page"]).filter((F.col("n_rows") >= 2) & (F.col("n_cols") >= 2) & (F.col("n_cells") >= LEAST_CELLS))
    title = F.trim("title")
    return t.select("id", "page", "n_rows", "n_cols", "n_cells", "bbox", F.when(F.length(title).between(*TITLE), title).alias("title"), F.round("mean", 4).alias("confidence"), (F.col("mean") >= PASSING).alias("passed"))
