"""Page layout: columns, reading order, paragraph windows, vertical bands. All inside one row a page, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import text as T

FULL_WIDTH, GUTTER, LEAST_HEIGHT, LEAST_LINES = 0.65, 0.12, 0.05, 2
LEAST_CHARS, PER_COLUMN = 20, 10


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` computed once a row and not copied into each use."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_columns_found(pages: DataFrame) -> DataFrame:
    """``pages(page_id, page_w, page_h, blocks)`` with ``placed``: the blocks in reading order, each with ``col``; and ``n_cols``.

    Candidates for gutters are narrow blocks of enough lines and height; a gap between sorted centres wider than
    the gutter starts a column at the right one; a block's column is the number of starts at or left of it.
    """
    w, h = F.col("page_w"), F.col("page_h")
    centre = lambda b: (b["bbox"]["hpos"] + b["bbox"]["w"] / 2) / w
    span = lambda b: b["bbox"]["w"] / w
    narrow = lambda b: (span(b) < FULL_WIDTH) & (F.size(b["lines"]) >= LEAST_LINES) & (b["bbox"]["h"] >= F.coalesce(h, F.lit(0)) * LEAST_HEIGHT)
    p = pages.where((w > 0) & (h > 0) & (F.size("blocks") > 0))
    p = once(p, "__c", F.array_sort(F.transform(F.filter("blocks", narrow), centre)))
    n = F.size("__c")
    starts = F.when(n >= 2, F.transform(
        F.filter(F.arrays_zip(F.slice("__c", 1, F.greatest(n - 1, F.lit(0))).alias("a"), F.slice("__c", 2, F.greatest(n - 1, F.lit(0))).alias("b")), lambda x: x["b"] - x["a"] > GUTTER),
        lambda x: x["b"],
    )).otherwise(F.array().cast("array<double>"))
    p = once(p, "__s", starts)
    column = lambda b: F.when(span(b) >= FULL_WIDTH, 0).otherwise(F.size(F.filter("__s", lambda s: centre(b) >= s)))
    placed = F.sort_array(F.transform("blocks", lambda b, i: F.struct(column(b).alias("col"), b["bbox"]["vpos"].alias("vpos"), i.alias("i"), b["bbox"].alias("bbox"), b["lines"].alias("lines"))))
    return once(p, "placed", placed).withColumn("n_cols", F.size("__s") + 1).drop("__c", "__s")


def reading_text(placed: Column) -> Column:
    """Lines of all blocks in reading order."""
    return F.array_join(F.flatten(F.transform(placed, lambda b: b["lines"])), "\n")


def columns(placed: Column) -> Column:
    """(col, own): the columns in order and the blocks of each that take part in windows, those of at least LEAST_CHARS characters."""
    joined = lambda b: F.array_join(b["lines"], "\n")
    cols = F.array_sort(F.array_distinct(F.transform(placed, lambda b: b["col"])))
    return F.transform(cols, lambda c: F.struct(c.alias("col"), F.filter(placed, lambda b: (b["col"] == c) & (F.length(T.strip(joined(b))) >= LEAST_CHARS)).alias("own")))


def runs(n: Column) -> Column:
    """(k, s): all runs of k neighbours from place s on among n blocks, short runs first."""
    of_length = lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda s: F.struct(k.alias("k"), s.alias("s")))
    return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(1), n), of_length)))


def window(c: Column, q: Column, part: Column) -> Column:
    """(col, win, start, text, box) of the blocks ``part`` of the run ``q`` in column ``c``."""
    box = lambda f: F.transform(part, f)
    return F.struct(
        c.alias("col"), q["k"].alias("win"), (q["s"] - 1).alias("start"), F.array_join(F.flatten(F.transform(part, lambda b: b["lines"])), "\n").alias("text"),
        F.array_min(box(lambda b: b["bbox"]["hpos"])).alias("x0"), F.array_min(box(lambda b: b["bbox"]["vpos"])).alias("y0"),
        F.array_max(box(lambda b: b["bbox"]["hpos"] + b["bbox"]["w"])).alias("x1"), F.array_max(box(lambda b: b["bbox"]["vpos"] + b["bbox"]["h"])).alias("y1"),
    )


def windows(pages: DataFrame) -> DataFrame:
    """(page_id, col, win, start, text, box): all runs of neighbouring blocks of a column of placed pages.

    Their number is quadratic in the blocks of a column, so each is a row before its text is built and a page of
    any length never holds the texts of all its windows at once.
    """
    p = pages.select("page_id", F.explode(columns(F.col("placed"))).alias("c")).select("page_id", "c.*")
    p = p.select("page_id", "col", "own", F.explode(runs(F.size("own"))).alias("q"))
    p = once(p.select("page_id", "col", "q", F.slice("own", F.col("q.s"), F.col("q.k")).alias("part")), "w", window(F.col("col"), F.col("q"), F.col("part")))
    return p.select("page_id", "w.*")


def paragraphs(pages: DataFrame, scale_x: float = 1.0, scale_y: float = 1.0) -> DataFrame:
    """(page_id, para, col, text, left, upper, right, lower) of the paragraph windows of placed pages.

    A fold over the ordered windows keeps the texts seen on the page and the count of the current column: a text
    occurs once a page, a column gives PER_COLUMN paragraphs at most, and a text only beyond a column's cap may
    still come from a later column. A text whose box is empty is seen but gives no paragraph. The fold walks the
    places of the windows and builds a window only where its column is not at its cap yet.
    """
    p = once(pages, "__c", columns(F.col("placed")))
    p = once(p, "__q", F.flatten(F.transform("__c", lambda c, i: F.coalesce(F.transform(runs(F.size(c["own"])), lambda q: F.struct(i.alias("c"), q["k"].alias("k"), q["s"].alias("s"))), F.array()))))
    kind = "array<struct<col:int,win:int,start:int,text:string,x0:int,y0:int,x1:int,y1:int>>"
    zero = F.struct(F.array().cast("array<string>").alias("seen"), F.lit(-1).alias("col"), F.lit(0).alias("k"), F.array().cast(kind).alias("out"))

    def step(a, q):
        c = F.get("__c", q["c"])
        k = F.when(a["col"] == c["col"], a["k"]).otherwise(0)
        full = F.struct(a["seen"].alias("seen"), c["col"].alias("col"), k.alias("k"), a["out"].alias("out"))
        return F.when(k >= PER_COLUMN, full).otherwise(T.let(window(c["col"], q, F.slice(c["own"], q["s"], q["k"])), lambda x: taken(a, k, x)))

    def taken(a, k, x):
        tried = (F.length(T.strip(x["text"])) >= LEAST_CHARS) & ~F.array_contains(a["seen"], x["text"])
        area = (F.least((x["x1"] * scale_x).cast("int"), F.col("page_w")) > F.greatest(F.lit(0), (x["x0"] * scale_x).cast("int"))) & (F.least((x["y1"] * scale_y).cast("int"), F.col("page_h")) > F.greatest(F.lit(0), (x["y0"] * scale_y).cast("int")))
        return F.struct(
            F.when(tried, F.concat(a["seen"], F.array(x["text"]))).otherwise(a["seen"]).alias("seen"), x["col"].alias("col"),
            F.when(tried & area, k + 1).otherwise(k).alias("k"), F.when(tried & area, F.concat(a["out"], F.array(x))).otherwise(a["out"]).alias("out"),
        )

    out = once(p, "__p", F.aggregate("__q", zero, step, lambda a: a["out"])).select("page_id", "page_w", "page_h", F.posexplode("__p").alias("para", "x"))
    return out.select(
        "page_id", (F.col("para") + 1).alias("para"), "x.col", "x.text",
        F.greatest(F.lit(0), (F.col("x.x0") * scale_x).cast("int")).alias("left"), F.greatest(F.lit(0), (F.col("x.y0") * scale_y).cast("int")).alias("upper"),
        F.least((F.col("x.x1") * scale_x).cast("int"), F.col("page_w")).alias("right"), F.least((F.col("x.y1") * scale_y).cast("int"), F.col("page_h")).alias("lower"),
    )


def band_lines(pages: DataFrame, n: int = 5, seed: str = "42") -> DataFrame:
    """``pages(page_id, lines<top, bottom, ...>)`` with a row for each of up to n bands of seeded heights: band, top, bottom, and ``own``, its lines.

    Heights are proportional to seeded draws and fill the content's extent; a band holds the lines inside it, or,
    if those are fewer than two, the lines that start inside; a band without two lines is skipped and the next
    one starts at the same place.
    """
    p = pages.where(F.size("lines") >= 2)
    top, bottom = F.array_min(F.transform("lines", lambda x: x["top"])), F.array_max(F.transform("lines", lambda x: x["bottom"]))
    p = once(p, "__e", F.struct(top.alias("top"), (bottom - top).alias("h"))).where("__e.h > 0")
    draw = lambda i: F.conv(F.substr(F.md5(F.concat_ws("|", F.lit(seed), F.col("page_id").cast("string"), i.cast("string"))), F.lit(1), F.lit(6)), 16, 10).cast("double") / float(16**6)
    p = once(p, "__d", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: 0.1 + 0.1 * draw(i)))
    total = F.aggregate("__d", F.lit(0.0), lambda a, x: a + x)
    p = once(p, "__b", F.transform("__d", lambda x: x / total * F.col("__e.h")))
    band = lambda lo, hi, own: F.struct(lo.cast("double").alias("top"), hi.cast("double").alias("bottom"), own.alias("own"))
    none = F.filter(F.array(band(F.lit(0.0), F.lit(0.0), F.col("lines"))), lambda x: F.lit(False))

    def step(a, h):
        lo, hi = a["at"], a["at"] + h
        inside = F.filter("lines", lambda x: (x["top"] >= lo) & (x["bottom"] <= hi))
        starts = F.filter("lines", lambda x: (x["top"] >= lo) & (x["top"] < hi))
        chosen = F.when(F.size(inside) >= 2, inside).otherwise(starts)
        ok = F.size(chosen) >= 2
        return F.struct(F.when(ok, hi).otherwise(lo).alias("at"), F.when(ok, F.concat(a["out"], F.array(band(lo, hi, chosen)))).otherwise(a["out"]).alias("out"))

    out = F.aggregate("__b", F.struct(F.col("__e.top").cast("double").alias("at"), none.alias("out")), step, lambda a: a["out"])
    return p.select(*pages.columns, F.posexplode(out).alias("band", "x")).select(*pages.columns, (F.col("band") + 1).alias("band"), "x.*")


def bands(pages: DataFrame, n: int = 5, seed: str = "42") -> DataFrame:
    """(page_id, band, top, bottom, text) of the bands of ``band_lines``."""
    text = F.array_join(F.transform("own", lambda x: x["text"]), "\n")
    return band_lines(pages, n, seed).select("page_id", "band", "top", "bottom", text.alias("text"))
