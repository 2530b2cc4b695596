"""Profile, split, mixture, join and set queries."""

from pyspark.sql import functions as F

from corpusforge.catalog import query
from corpusforge.functions import text as T
from corpusforge.operators import profile as P
from corpusforge.operators import ranking as K
from corpusforge.operators import records as R
from corpusforge.plans.sqltext import some, words
from corpusforge.runtime import small, table


def _m(spark, d):
    return table(spark, d, "manifest")


@query("A7 W13", "select source, n, round(100.0 * n / sum(n) over (), 6) as percent from (select source, count(*) as n from manifest group by source)")
def source_breakdown(spark, d):
    return P.shares(_m(spark, d), "source").withColumn("percent", F.round("percent", 6))


def _profile_sql(value, name):
    v = f"case when length(text) > 0 then {value} end"
    q = ", ".join(f"list_sort(list(v) filter (where v is not null))[least(floor(count(v) * {p} / 100.0), count(v) - 1)::bigint + 1]::bigint as {name}_p{p}" for p in (25, 50, 75))
    return f"""with t as (select source, {v} as v from manifest)
        select source, count(*) as n, sum(v)::bigint as {name}_total, round(coalesce(sum(v), 0) / count(*), 6) as {name}_mean, min(v)::bigint as {name}_min, max(v)::bigint as {name}_max, {q} from t group by source"""


def _profile(spark, d, name):
    p = P.length_profile(_m(spark, d).withColumn("source", F.coalesce("source", F.lit("\u0000"))), ["source"])
    p = p.withColumn("source", F.nullif("source", F.lit("\u0000")))
    ints = [f"{name}_{x}" for x in ("total", "min", "max", "p25", "p50", "p75")]
    return p.select("source", "n", F.round(f"{name}_mean", 6).alias(f"{name}_mean"), *[F.col(c).cast("bigint").alias(c) for c in ints])


@query("A8 A3 F7", _profile_sql("length(text)", "chars"))
def char_stats(spark, d):
    return _profile(spark, d, "chars")


@query("A8 A3 F6", _profile_sql(f"len({words('text')})", "n_words"))
def word_stats(spark, d):
    return _profile(spark, d, "n_words")


@query("A3", "select l_returnflag, " + ", ".join(f"list_sort(list(l_extendedprice))[floor(count(*) * {p} / 100.0)::bigint + 1] as p{p}" for p in (25, 50, 75)) + " from lineitem group by l_returnflag")
def floor_percentiles(spark, d):
    return K.floor_percentiles(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", [25, 50, 75])


@query("A2 A4", "select l_shipmode_n, n, round(p50, 6) as p50, round(p99, 6) as p99 from (select l_linenumber as l_shipmode_n, count(*) as n, quantile_cont(l_extendedprice, 0.5) as p50, quantile_cont(l_extendedprice, 0.99) as p99 from lineitem group by 1)")
def price_percentiles(spark, d):
    q = K.interpolated_percentiles(table(spark, d, "lineitem").withColumnRenamed("l_linenumber", "l_shipmode_n"), ["l_shipmode_n"], "l_extendedprice", [50, 99])
    return q.select("l_shipmode_n", "n", F.round("p50", 6).alias("p50"), F.round("p99", 6).alias("p99"))


@query("A18 A9", "select source, sum(octet_length(image.bytes))::bigint as bytes from manifest group by source")
def embedded_bytes(spark, d):
    return _m(spark, d).groupBy("source").agg(F.sum(F.octet_length("image.bytes")).cast("bigint").alias("bytes"))


@query("A9 P19", """with b as (select rec_id, image.bytes as b, hex(image.bytes) as x from manifest)
    select rec_id, ('0x' || substr(x, 33, 8))::bigint as width, ('0x' || substr(x, 41, 8))::bigint as height, octet_length(b)::int as bytes from b where starts_with(x, '89504E470D0A1A0A')""")
def image_sizes(spark, d):
    return _m(spark, d).select("rec_id", *P.png_size()).where("width is not null")


@query("O7", "select rec_id from manifest order by md5('42' || rec_id::varchar), rec_id limit 100")
def seeded_sample_n(spark, d):
    return P.seeded_sample(_m(spark, d).select("rec_id"), "rec_id", 100)


@query("S2 W7", "select source, rec_id from (select source, rec_id, row_number() over (partition by source order by rec_id) as r from manifest) where r <= 200")
def first_per_source(spark, d):
    return P.first_per_source(_m(spark, d).select("source", "rec_id"), "source", "rec_id", 200)


@query("A10", "select source, count(distinct images[1]) as images from eval_results group by source")
def distinct_images_per_category(spark, d):
    return table(spark, d, "eval_results").groupBy("source").agg(F.count_distinct(F.get("images", F.lit(0))).alias("images"))


RANKED = f"""r as (select rec_id, file_name, source, row_number() over (order by md5(coalesce(file_name, rec_id::varchar)) || md5(rec_id::varchar)) - 1 as rank, count(*) over () as n from manifest where {some('text')}),
    s as (select *, case when rank < floor(n * 0.9::double) then 'train' when rank < floor(n * 0.9::double) + floor(n * 0.05::double) then 'eval' else 'test' end as split from r)"""


def _ranked(spark, d):
    m = _m(spark, d).where(~T.is_blank(F.col("text"))).select("rec_id", "file_name", "source")
    return K.hash_ranked(m, F.coalesce("file_name", F.col("rec_id").cast("string")), F.col("rec_id"))  # unnamed records are named by their id


def _split(spark, d):
    r, n = _ranked(spark, d)
    return r.withColumn("split", K.split_of(F.col("rank"), n, 0.9, 0.05))


@query("O1 W8 R1 L6", f"with {RANKED} select rec_id, split from s")
def hash_split_3way(spark, d):
    return _split(spark, d).select("rec_id", "split")


@query("A23 W8", f"with {RANKED} select source, split, count(*) as n from s group by source, split")
def split_counts(spark, d):
    return _split(spark, d).groupBy("source", "split").agg(F.count("*").alias("n"))


_ENTRY_SPLITS = "s as (select entry_id, case split_name when 'validation' then 'eval' else split_name end as split, images[1] as image from chat_entries where split_name is not null)"
ORD = "case split when 'train' then 0 when 'eval' then 1 else 2 end"


@query("J5 R2", f"with {_ENTRY_SPLITS}, o as (select *, {ORD} as o, min({ORD}) over (partition by image) as first from s) select entry_id, split from o where o = first or image is null")
def leak_free_split(spark, d):
    """Entries whose first image stands in no earlier split."""
    split = F.when(F.col("split_name") == "validation", "eval").otherwise(F.col("split_name"))
    e = table(spark, d, "chat_entries").where("split_name is not null").select("entry_id", split.alias("split"), F.get("images", F.lit(0)).alias("image"))
    return K.leak_free(e, "split", "image").select("entry_id", "split")


@query("W9 R6", f"with {RANKED} select rec_id, (case when rank >= floor(n * 0.9::double) then -1 else least(floor(rank / floor(floor(n * 0.9::double) / 5)), 4) end)::bigint as fold from r")
def kfold_assign(spark, d):
    r, n = _ranked(spark, d)
    return r.select("rec_id", K.folds(F.col("rank"), n, 5, 0.9).cast("bigint").alias("fold"))


@query("W9 A11", f"with {RANKED} select (case when rank >= floor(n * 0.9::double) then -1 else least(floor(rank / floor(floor(n * 0.9::double) / 5)), 4) end)::bigint as fold, count(*) as n from r group by 1")
def kfold_counts(spark, d):
    return kfold_assign(spark, d).groupBy("fold").agg(F.count("*").alias("n"))


@query("W8 R9", f"with {RANKED} select rec_id, case when rank < floor(n * (0.9::double / (0.9::double + 0.1::double))) then 'train' else 'eval' end as split from r")
def two_way_split(spark, d):
    r, n = _ranked(spark, d)
    return r.select("rec_id", K.two_way(F.col("rank"), n, 0.9, 0.1).alias("split"))


@query("W10", f"with {RANKED} select rec_id, rank % 8 as shard from r")
def shard_round_robin(spark, d):
    r, _ = _ranked(spark, d)
    return r.select("rec_id", (F.col("rank") % 8).alias("shard"))


@query("W11", f"with {RANKED} select rec_id, floor(rank / ceil(n / 20.0))::bigint as batch from r")
def batch_assign(spark, d):
    r, n = _ranked(spark, d)
    return r.select("rec_id", K.batch_of(F.col("rank"), n).cast("bigint").alias("batch"))


@query("W1", "select source, rec_id, row_number() over (partition by source order by rec_id)::bigint as ordinal from manifest")
def ordinals(spark, d):
    return K.rank_in_group(_m(spark, d).select("source", "rec_id"), "source", ["rec_id"], "ordinal").withColumn("ordinal", F.col("ordinal").cast("bigint"))


def _mix_sql(w):
    return f"select source, n, round(w / sum(w) over (), 9) as prob from (select source, n, {w} as w from (select source, count(*) as n from manifest group by source))"


def _mix(spark, d, mode):
    return P.probabilities(_m(spark, d), "source", mode).withColumn("prob", F.round("prob", 9))


@query("A13", _mix_sql("n::double"))
def mix_proportional(spark, d):
    return _mix(spark, d, "proportional")


@query("A13", _mix_sql("1.0::double"))
def mix_equal(spark, d):
    return _mix(spark, d, "equal")


@query("A13 Q1", _mix_sql("sqrt(n)"))
def mix_sqrt(spark, d):
    return _mix(spark, d, "sqrt")


@query("A13 Q1", _mix_sql("1 / sqrt(n)"))
def mix_inv_sqrt(spark, d):
    return _mix(spark, d, "inv_sqrt")


@query("O11 J11", "select doc_id from documents where n_chars > 0 order by -ln(greatest(('0x' || substr(md5('42' || doc_id::varchar), 1, 13))::bigint / 4503599627370496.0, 1.1102230246251565e-16)) / n_chars, doc_id limit 100")
def weighted_sample_wo_repl(spark, d):
    return P.weighted_sample(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 100).select("doc_id")


@query("A13", "select t.source, t.target_share, coalesce(m.n, 0) as n from mix_targets t left join (select source, count(*) as n from manifest group by source) m on t.source = m.source")
def mixture_config(spark, d):
    n = _m(spark, d).groupBy("source").agg(F.count("*").alias("n"))
    return table(spark, d, "mix_targets").join(n, "source", "left").select("source", "target_share", F.coalesce("n", F.lit(0)).alias("n"))


@query("U1", "select e.result_id, c.entry_id, c.split_name from eval_results e join chat_entries c on e.entry_id = c.entry_id")
def image_gt_inner(spark, d):
    return table(spark, d, "eval_results").join(table(spark, d, "chat_entries").select("entry_id", "split_name"), "entry_id").select("result_id", "entry_id", "split_name")


@query("X6", "select o.o_orderkey, n.n_name from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey")
def index_lookup_broadcast(spark, d):
    c = table(spark, d, "customer").join(small(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name")


@query("J4 J6", "select entry_id from chat_entries c where not exists (select 1 from eval_results e where e.entry_id = c.entry_id)")
def used_anti_join(spark, d):
    return table(spark, d, "chat_entries").select("entry_id").join(table(spark, d, "eval_results").select("entry_id"), "entry_id", "left_anti")


@query("J5", "select entry_id from chat_entries c where exists (select 1 from eval_results e where e.entry_id = c.entry_id)")
def leakage_semi(spark, d):
    return table(spark, d, "chat_entries").select("entry_id").join(table(spark, d, "eval_results").select("entry_id"), "entry_id", "left_semi")


@query("F24", "select o_orderkey, ((o_totalprice >= 50000)::int + (o_totalprice >= 100000)::int + (o_totalprice >= 200000)::int)::bigint as band from orders")
def band_join(spark, d):
    bounds = F.array(*[F.lit(float(b)) for b in (50_000, 100_000, 200_000)])
    return table(spark, d, "orders").select("o_orderkey", F.size(F.filter(bounds, lambda b: F.col("o_totalprice") >= b)).cast("bigint").alias("band"))


@query("J9", """with n as (select *, unnest(generate_series(0, least(len(messages), len(images)) - 1)) as pos from chat_entries where images is not null and len(images) > 0)
    select entry_id, pos::int as pos, messages[pos + 1].role as role, images[pos + 1] as i from n""")
def positional_zip(spark, d):
    c = table(spark, d, "chat_entries").where("images is not null")
    n = F.least(F.size("messages"), F.size("images"))
    return c.where(n > 0).select("entry_id", F.posexplode(F.arrays_zip(F.slice("messages", 1, n).alias("m"), F.slice("images", 1, n).alias("i"))).alias("pos", "z")).select("entry_id", "pos", "z.m.role", "z.i")


@query("U1", "select source, count(*) as n from (select source from manifest union all select source from documents) group by source")
def union_all_parts(spark, d):
    u = _m(spark, d).select("source", "type").unionByName(table(spark, d, "documents").select("source"), allowMissingColumns=True)
    return u.groupBy("source").agg(F.count("*").alias("n"))


@query("U2", "select distinct a.image from (select unnest(images) as image, split_name from chat_entries) a join (select unnest(images) as image, split_name from chat_entries) b on a.image = b.image and a.split_name < b.split_name")
def split_intersect(spark, d):
    i = table(spark, d, "chat_entries").select("split_name", F.explode("images").alias("image"))
    return i.groupBy("image").agg(F.count_distinct("split_name").alias("k")).where("k > 1").select("image")


@query("U3", "select entry_id from (select entry_id, images[1] as image from chat_entries where split_name = 'test') t where not exists (select 1 from chat_entries c where c.split_name = 'train' and c.images[1] = t.image)")
def except_filter(spark, d):
    c = table(spark, d, "chat_entries").select("entry_id", "split_name", F.get("images", F.lit(0)).alias("image"))
    return c.where("split_name = 'test'").join(c.where("split_name = 'train'").select("image"), "image", "left_anti").select("entry_id")


@query("U4 A17", "select count(distinct text) as texts, count(text) as n from manifest")
def distinct_texts(spark, d):
    return _m(spark, d).agg(F.count_distinct("text").alias("texts"), F.count("text").alias("n"))
