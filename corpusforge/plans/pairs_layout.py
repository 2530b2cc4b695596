"""Preference, layout, raster and stream queries."""

from pyspark.sql import functions as F

from corpusforge.catalog import query
from corpusforge.operators import layout as L
from corpusforge.operators import preference as P
from corpusforge.operators import raster as G
from corpusforge.plans.sqltext import SCORED, strip
from corpusforge.runtime import fresh_dir, spread, table
from corpusforge.streaming import ingest

KEEP = f"""{SCORED}, t as (select *, {strip('ref')} as chosen, {strip('pred')} as rejected, regexp_replace(image, '^.*/', '') as image_name from s),
    tv as (select *, list_distinct(list_concat(regexp_extract_all(chosen, '(?s).'), regexp_extract_all(rejected, '(?s).'))) as v2 from t),
    td as (select *, levenshtein(array_to_string(list_transform(regexp_extract_all(chosen, '(?s).'), lambda t: chr(list_position(v2, t)::int)), ''),
        array_to_string(list_transform(regexp_extract_all(rejected, '(?s).'), lambda t: chr(list_position(v2, t)::int)), '')) as d2 from tv),
    f as (select *, case when chosen = rejected then 'no_diff'
        when d2 / greatest(length(chosen), length(rejected)) < 0.05 or d2 / greatest(length(chosen), length(rejected)) > 0.7 or (case when length(chosen) = 0 then 1.0 else d2 / length(chosen) end) < 0.1 then 'low_ned'
        when image_name is null then 'missing' else 'kept' end as stage0 from td),
    g as (select *, case when stage0 = 'kept' and row_number() over (partition by stage0, image_name order by result_id) > 1 then 'dup_image' else stage0 end as stage from f)"""


def _staged(spark, d):
    return P.first_wins(P.staged(spread(table(spark, d, "eval_results"))), ["result_id"])


@query("L13 P13 P14 R3", f"with {KEEP} select result_id, stage from g")
def pref_stages(spark, d):
    return _staged(spark, d).select("result_id", "stage")


@query("A14", f"with {KEEP} select run_name, count(*) as total, " + ", ".join(f"count(*) filter (where stage = '{s}') as {s}" for s in ("no_diff", "low_ned", "missing", "dup_image", "kept")) + " from g group by run_name")
def pref_funnel(spark, d):
    return P.funnel(_staged(spark, d), "run_name")


@query("W6", f"with {KEEP} select image_name, min(result_id) as result_id from g where stage = 'kept' group by image_name")
def pref_first_wins(spark, d):
    return _staged(spark, d).where("stage = 'kept'").select("image_name", "result_id")


@query("P8 D9", f"with {KEEP} select result_id, chosen, rejected, image, 'ocr-dpo-' || source as category from g where stage = 'kept'")
def pref_pairs(spark, d):
    k = _staged(spark, d).where("stage = 'kept'").select("result_id", *P.pair_record(F.col("chosen"), F.col("rejected"), F.col("image"), F.concat(F.lit("ocr-dpo-"), F.col("source"))))
    return k.select("result_id", F.get("chosen_response", F.lit(0))["content"].alias("chosen"), F.get("rejected_response", F.lit(0))["content"].alias("rejected"), F.get("images", F.lit(0)).alias("image"), "category")


@query("U1 J4", f"with {KEEP} select distinct image_name from g where image_name is not null and image_name not in (select image_name from g where stage = 'kept')")
def pref_synth_only(spark, d):
    s = _staged(spark, d)
    return s.where("image_name is not null").select("image_name").join(s.where("stage = 'kept'").select("image_name"), "image_name", "left_anti").distinct()


CAPPED = ["aida-handwritten", "aida-ship-info"]


@query("W5 R7", "select result_id from (select result_id, source, row_number() over (partition by source order by result_id) as r, (select greatest(1, floor(count(*) * 0.025::double)) from eval_results) as cap from eval_results) where source is null or source not in ('aida-handwritten', 'aida-ship-info') or r <= cap")
def pref_category_cap(spark, d):
    return P.capped(table(spark, d, "eval_results").select("result_id", "source"), "source", CAPPED, ["result_id"]).select("result_id")


@query("W14 R8 O10", """with e as (select result_id, source, coalesce(source in ('theseus', 'nlf_fi'), false) as p from eval_results),
    c as (select count(*) filter (where p) as np, count(*) filter (where not p) as no from e),
    r as (select result_id, row_number() over (order by md5('42' || result_id::varchar), result_id) - 1 as i, np, greatest(0, no - np) as need from e, c where p)
    select result_id, 0 as copy from e where not p union all
    select result_id, unnest(generate_series(0, (need // np + case when i < need % np then 1 else 0 end)::int))::int as copy from r""")
def pref_oversample(spark, d):
    return P.oversampled(table(spark, d, "eval_results").select("result_id", "source"), "source", ["theseus", "nlf_fi"], "result_id").select("result_id", "copy")


@query("A7", f"with {KEEP} select 'ocr-dpo-' || source as category, count(*) as n from g where stage = 'kept' group by 1")
def pref_category_distribution(spark, d):
    return _staged(spark, d).where("stage = 'kept'").groupBy(F.concat(F.lit("ocr-dpo-"), F.col("source")).alias("category")).agg(F.count("*").alias("n"))


def _pages(spark, d):
    """Pages laid out from documents: each paragraph a block, its place from its number and length."""
    docs = table(spark, d, "documents").where(F.length("text") > 0).select("doc_id", F.filter(F.split("text", "\n\n"), lambda b: F.length(b) > 0).alias("p"))
    block = lambda b, i: F.struct(
        F.struct((50 + (i % 3) * 300).cast("int").alias("hpos"), (100 + i * 40).cast("int").alias("vpos"), F.when(i % 7 == 0, 900).otherwise(280).cast("int").alias("w"), (60 + F.length(b) % 200).cast("int").alias("h")).alias("bbox"),
        F.split(b, "\n").alias("lines"),
    )
    return docs.select(F.col("doc_id").alias("page_id"), F.lit(1000).alias("page_w"), F.lit(2000).alias("page_h"), F.transform("p", block).alias("blocks"))


_BLOCKS = """p as (select doc_id, list_filter(string_split(text, chr(10) || chr(10)), lambda x: length(x) > 0) as p from documents where length(text) > 0),
    q as (select doc_id, unnest(list_transform(p, lambda x, i: {'i': i - 1, 't': x})) as q from p),
    b as (select doc_id, q.i as i, q.t as t, 50 + (q.i % 3) * 300 as hpos, 100 + q.i * 40 as vpos, case when q.i % 7 = 0 then 900 else 280 end as w, 60 + length(q.t) % 200 as h from q),
    c as (select *, (hpos + w / 2.0) / 1000.0 as centre, w / 1000.0 as span from b),
    n as (select doc_id, centre, lag(centre) over (partition by doc_id order by centre) as before from c where span < 0.65 and len(string_split(t, chr(10))) >= 2 and h >= 100),
    s as (select doc_id, list(centre) as s from n where centre - before > 0.12 group by doc_id),
    placed as (select c.*, len(coalesce(s.s, [])) + 1 as n_cols, case when span >= 0.65 then 0 else len(list_filter(coalesce(s.s, []), lambda x: centre >= x)) end as col from c left join s on c.doc_id = s.doc_id)"""


@query("L1 W2 J7 R5", f"with {_BLOCKS} select doc_id as page_id, n_cols::int as n_cols, i::int as block, col::int as col from placed")
def column_detect(spark, d):
    p = L.with_columns_found(_pages(spark, d)).select("page_id", "n_cols", F.explode("placed").alias("b"))
    return p.select("page_id", "n_cols", F.col("b.i").alias("block"), F.col("b.col").alias("col"))


@query("L2 O2 A16", f"with {_BLOCKS} select doc_id as page_id, md5(string_agg(t, chr(10) order by col, vpos, i)) as text_md5 from placed group by doc_id")
def reading_order_text(spark, d):
    return L.with_columns_found(_pages(spark, d)).select("page_id", F.md5(L.reading_text(F.col("placed"))).alias("text_md5"))


@query("W4 L3 X5", f"""with {_BLOCKS}, o as (select doc_id, col, length(t) as n, row_number() over w - 1 as r, sum(length(t)) over w as upto from placed where length({strip('t')}) >= 20 window w as (partition by doc_id, col order by vpos, i))
    select a.doc_id as page_id, a.col::int as col, (e.r - a.r + 1)::int as win, a.r::int as start, (e.upto - a.upto + a.n + e.r - a.r)::int as chars from o a join o e on a.doc_id = e.doc_id and a.col = e.col and e.r >= a.r""")
def sliding_windows(spark, d):
    return L.windows(L.with_columns_found(_pages(spark, d))).select("page_id", "col", "win", "start", F.length("text").alias("chars"))


@query("L3 R4 P16 P17 A15 W7")
def paragraph_dedup_cap(spark, d):
    return L.paragraphs(L.with_columns_found(_pages(spark, d))).drop("text")


@query("A15", """with b as (select doc_id, list_filter(string_split(text, chr(10) || chr(10)), lambda x: length(x) > 0) as p from documents where length(text) > 0),
    c as (select doc_id, unnest(list_transform(p, lambda x, i: {'i': i - 1, 'n': length(x)})) as q from b)
    select doc_id as page_id, min(50 + (q.i % 3) * 300)::bigint as x0, min(100 + q.i * 40)::bigint as y0, max(50 + (q.i % 3) * 300 + case when q.i % 7 = 0 then 900 else 280 end)::bigint as x1, max(100 + q.i * 40 + 60 + q.n % 200)::bigint as y1 from c group by doc_id""")
def bbox_union(spark, d):
    b = _pages(spark, d).select("page_id", F.transform("blocks", lambda x: x["bbox"]).alias("b"))
    low = lambda k: F.array_min(F.transform("b", lambda x: x[k])).cast("bigint")
    high = lambda k, s: F.array_max(F.transform("b", lambda x: x[k] + x[s])).cast("bigint")
    return b.select("page_id", low("hpos").alias("x0"), low("vpos").alias("y0"), high("hpos", "w").alias("x1"), high("vpos", "h").alias("y1"))


@query("A12", f"with {_BLOCKS} select n_cols::int as n_cols, count(distinct doc_id) as pages from placed group by n_cols")
def column_count_hist(spark, d):
    return L.with_columns_found(_pages(spark, d)).groupBy("n_cols").agg(F.count("*").alias("pages"))


@query("L4 W3 P24 J8")
def vertical_bands(spark, d):
    lines = table(spark, d, "documents").where(F.length("text") > 0).select(F.col("doc_id").alias("page_id"), F.split("text", "\n").alias("t"))
    line = lambda x, i: F.struct(x.alias("text"), (i * 20).cast("double").alias("top"), (i * 20 + 15).cast("double").alias("bottom"))
    return L.bands(lines.select("page_id", F.transform("t", line).alias("lines")))


def _rasters(spark, d):
    """64 x 64 grey rasters from the 64 numbers of each embedding, an 8 x 8 block each."""
    pixel = lambda x: F.repeat(F.lpad(F.hex(F.greatest(F.lit(0), F.least(F.lit(255), F.floor(x * 64 + 128)))), 2, "0"), F.lit(8))
    row = lambda r: F.repeat(F.array_join(F.transform(F.slice("embedding", r * 8 + 1, F.lit(8)), pixel), ""), F.lit(8))
    e = table(spark, d, "embeddings").where(F.size("embedding") == 64)
    return e.select(F.col("vec_id").alias("id"), F.lit(64).alias("h"), F.lit(64).alias("w"), F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), row), "")).alias("data"))


def _one(spark, d, name, **params):
    r = _rasters(spark, d)
    return G.augmented(r, r.select("id", F.array(F.lit(0)).alias("picks")), entries=[{"name": name, "params": params}]).select("id", "h", "w", F.md5(F.hex("data")).alias("pixels_md5"), "error")


@query("G1 G2 G3 G4 G5 G6 G7 G8 G9 G10 G11 G12 G13 G14 G15 G16 G17 G18 G19 G20 G21 G22 G23 G24")
def augment_each(spark, d):
    """Every image under every transform, one at a time, with what it did to the pixels."""
    names = sorted(G.TRANSFORMS)
    r = _rasters(spark, d).withColumnRenamed("id", "vec_id").withColumn("k", F.explode(F.array(*map(F.lit, range(len(names))))))
    r = r.select((F.col("vec_id") * 100 + F.col("k")).alias("id"), "h", "w", "data", "k")
    a = G.augmented(r, r.select("id", F.array("k").alias("picks")), entries=[{"name": n} for n in names])
    name = F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 100 + 1).cast("int"))
    return a.select(F.expr("id div 100").alias("vec_id"), name.alias("transform"), "h", "w", F.md5("data").alias("pixels_md5"), "error")


_GREY = "greatest(0, least(255, floor(embedding[(r * 8 + c + 1)::int] * 64 + 128)))::bigint"
_HEX = f"lpad(to_hex({_GREY}), 2, '0')"


def _grid_sql(row, n_rows, n_cols, before="", after=""):
    return f"select vec_id as id, {n_rows} as h, {n_cols} as w, md5({before}array_to_string(list_transform(generate_series(0, 7), lambda r: {row}), ''){after}) as pixels_md5, null::varchar as error from embeddings where len(embedding) = 64"


_CELLS = f"array_to_string(list_transform(generate_series(0, 7), lambda c: repeat({_HEX}, 8)), '')"


@query("G10", _grid_sql(f"repeat(repeat('FF', 8) || {_CELLS} || repeat('FF', 8), 8)", 80, 80, "repeat('FF', 640) || ", " || repeat('FF', 640)"))
def pad_white(spark, d):
    """A quarter more on each side of the middle: nothing is left to chance."""
    return _one(spark, d, "image_padding", w_ratio=(0.25, 0.25), h_ratio=(0.25, 0.25), center=True)


@query("G22 G23", "with m as (select vec_id, list_transform(generate_series(0, 3), lambda R: list_transform(generate_series(0, 3), lambda C: list_sum(list_transform(generate_series(0, 3), lambda k: greatest(0, least(255, floor(embedding[((2 * R + k // 2) * 8 + 2 * C + k % 2 + 1)::int] * 64 + 128))))) / 4)) as g from embeddings where len(embedding) = 64) "
    "select vec_id as id, 64 as h, 64 as w, md5(array_to_string(list_transform(g, lambda row: repeat(array_to_string(list_transform(row, lambda v: repeat(lpad(to_hex(round_even(v, 0)::bigint), 2, '0'), 16)), ''), 16)), '')) as pixels_md5, null::varchar as error from m")  # fmt: skip
def mosaic(spark, d):
    """The whole image in cells of 16 pixels, whose middle lies on the corner of four blocks."""
    return _one(spark, d, "mask_mosaic", coords=[(0, 0, 64, 64)], size=16)


@query("G23", _grid_sql(_CELLS.join(["repeat(", ", 8)"]), 64, 64))
def mask_of_nothing(spark, d):
    """Boxes outside the image, or empty, change nothing."""
    return _one(spark, d, "mask_random_block", coords=[(70, 0, 90, 20), (5, 5, 5, 9), (-9, -9, 0, 0)])


# Category weights of the augmentation policy.
POLICY = {"strategy": "weighted", "num_transforms": [1, 3], "category_weights": {"region_mask": 0.15, "noise": 0.25, "distortion": 0.20, "degradation": 0.20, "geometric": 0.10, "padding": 0.10}}
ENTRIES = [
    {"name": n, "p": 0.5, "category": c}
    for n, c in (
        ("gaussian_noise", "noise"), ("iso_noise", "noise"), ("mask_salt_pepper", "region_mask"), ("mask_mosaic", "region_mask"), ("curve", "distortion"),
        ("grid_distortion", "distortion"), ("gaussian_blur", "degradation"), ("motion_blur", "degradation"), ("rotation", "geometric"), ("image_padding", "padding"), ("line_overlay", "default"),
    )
]


def _policy_sql():
    rows = ", ".join(f"({k}, '{e['name']}', '{e['category']}', {POLICY['category_weights'].get(e['category'], 0.0)})" for k, e in enumerate(ENTRIES))
    u = lambda *w: f"(('0x' || substr(md5(concat_ws('|', '42', {', '.join(w)})), 1, 13))::bigint / 4503599627370496.0)"
    entry = "name || '#' || k"
    return f"""with e(k, name, category, weight) as (values {rows}),
        x as (select vec_id as id, e.* from embeddings, e where len(embedding) = 64 and {u("'gate'", "vec_id::varchar", entry)} < 0.5),
        s as (select *, weight / count(*) over (partition by id, category) as share from x),
        q as (select *, -ln(greatest({u("'draw'", "id::varchar", entry)}, 1.1102230246251565e-16)) / share as key from s where share > 0),
        r as (select *, row_number() over (partition by id order by key, k) as r, 1 + floor({u("'n'", "id::varchar")} * 3) as n from q)
        select id, string_agg(name, ',' order by {u("'order'", "id::varchar", entry)}, k) as transforms from r where r <= n group by id"""


@query("G26 O11 O12 J10 J11 A20 Q26", _policy_sql())
def policy_transform_choice(spark, d):
    return G.transform_plan(_rasters(spark, d), ENTRIES, POLICY).select("id", F.array_join("transforms", ",").alias("transforms"))


@query("G24 G25 G26 S19 X2")
def policy_augmented(spark, d):
    r = _rasters(spark, d)
    entries, policy = G.load_config({"augmentations": ENTRIES, "augmentation_policy": POLICY})
    return G.augmented(r, G.transform_plan(r, entries, policy), entries=entries).select("id", "h", "w", F.md5("data").alias("pixels_md5"), "error")


@query("G27 G28")
def gated_augmented(spark, d):
    """Brought to a model's size, then every entry behind its own gate."""
    return G.preprocessed(_rasters(spark, d), ENTRIES, 3000, 6000, 14).select("id", "h", "w", F.md5("data").alias("pixels_md5"), "error")


@query("W11 2.13", "select event_type, count(distinct event_id) as n from events group by event_type")
def incremental_ingest(spark, d):
    """Events through the file stream until none is left, then read back."""
    root = fresh_dir(spark, "ingest")
    e = table(spark, d, "events")
    stream = spark.readStream.schema(e.schema).option("pathGlobFilter", "events*.parquet").parquet(d)
    ingest.run_available(ingest.first_seen(stream, "event_id", "ts"), f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count("*").alias("n"))


@query("2.13", "select date_trunc('day', ts) as start, event_type, count(*) as n from events group by 1, 2")
def event_windows(spark, d):
    return ingest.windowed_counts(table(spark, d, "events"), "ts", "event_type")
