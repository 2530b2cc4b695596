"""Queries pN_... of the training-data operators and the SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.llm import chunking, encoding, langid, leakage, mixing, normal, overlap, packing, splits, truncation
from corpusforge.runtime import cut, table

TARGETS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def p1_found(spark, d):
    return langid.wrong_labels(table(spark, d, "manifest"), table(spark, d, "lang_samples"))


def p1_segments(spark, d):
    r = langid.identify(table(spark, d, "manifest").select("rec_id", langid.declared(F.col("lang")).alias("declared"), "text"), table(spark, d, "lang_samples"))
    return r.select("rec_id", "declared", F.posexplode("segments").alias("segment", "s")).select("rec_id", "declared", "segment", "s.*")


def p2_found(spark, d):
    m, e = table(spark, d, "manifest"), table(spark, d, "eval_results")
    odd = cut(normal.deviating(m, "rec_id", "text").select("rec_id", "text"))  # only these can be both; problem 4 looks at them alone
    in_manifest = odd.select("rec_id").join(encoding.found(m, odd), "rec_id", "left_anti")
    in_eval = normal.deviating(e, "result_id", "answer")
    return in_manifest.select(F.lit("manifest").alias("tab"), F.col("rec_id").alias("row_id")).unionByName(in_eval.select(F.lit("eval_results").alias("tab"), F.col("result_id").alias("row_id")))


def p2_normalised(spark, d):
    m, e = table(spark, d, "manifest"), table(spark, d, "eval_results")
    a = m.select(F.lit("manifest").alias("tab"), F.col("rec_id").alias("row_id"), F.col("text"))
    b = e.select(F.lit("eval_results").alias("tab"), F.col("result_id").alias("row_id"), F.col("answer").alias("text"))
    return a.unionByName(b).select("tab", "row_id", normal.normalise(F.col("text")).alias("text"))


def _mixed(spark, d):
    copies, plan = mixing.mix(table(spark, d, "manifest"), table(spark, d, "mix_targets"))
    return cut(copies), plan


def p3_found(spark, d):
    copies, plan = _mixed(spark, d)
    return mixing.report(copies, plan).where("short").select("source")


def p3_report(spark, d):
    copies, plan = _mixed(spark, d)
    return mixing.report(copies, plan)


def p3_mix(spark, d):
    return _mixed(spark, d)[0].where("copies > 0")


def p4_method(spark, d):
    return encoding.found_by_records(table(spark, d, "manifest"))


def p4_found(spark, d):
    return encoding.found(table(spark, d, "manifest"))


def p4_restored(spark, d):
    return encoding.restored(table(spark, d, "manifest"))


def _grouped(spark, d):
    m = table(spark, d, "manifest").select("rec_id", splits.scanned_item().alias("item"))
    return splits.grouped(m, "rec_id", {"item": F.col("item")})


def p5_found(spark, d):
    g = _grouped(spark, d).where("item is not null").select("rec_id", "group_id")
    several = g.groupBy("group_id").agg(F.count("*").alias("n")).where("n >= 2").select("group_id")
    return g.join(several, "group_id").select("rec_id", F.col("group_id").alias("group_rec_id"))


def p5_splits(spark, d):
    g = cut(_grouped(spark, d).select("rec_id", "group_id"))
    return g.join(splits.assign_splits(g, TARGETS), "group_id").select("rec_id", "group_id", "split")


def p5_report(spark, d):
    s = splits.assign_splits(_grouped(spark, d).select("group_id"), TARGETS).groupBy("split").agg(F.count("*").alias("groups"), F.sum("n").alias("records"))
    return s.join(F.broadcast(spark.createDataFrame(list(TARGETS.items()), "split string, target double")), "split")


def p6_method(spark, d):
    return truncation.by_trigrams(table(spark, d, "eval_results"))


def p6_found(spark, d):
    return truncation.truncated(table(spark, d, "eval_results")).select("result_id")


def p6_rates(spark, d):
    return truncation.rates(table(spark, d, "eval_results"))


def p7_found(spark, d):
    return overlap.pairs(table(spark, d, "chat_entries"))


def p7_counts(spark, d):
    return overlap.counts(table(spark, d, "chat_entries"))


def p8_sequences(spark, d):
    return packing.packed(table(spark, d, "documents"))


def p8_fills(spark, d):
    return packing.fills(packing.packed(table(spark, d, "documents")))


def p9_found(spark, d):
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "heldout_items")).select("doc_id", "item_id")


def p9_clean(spark, d):
    docs = table(spark, d, "documents")
    return leakage.without_spans(docs, cut(leakage.passages(docs, table(spark, d, "heldout_items"))))


def p10_found(spark, d):
    return chunking.split_long(table(spark, d, "documents")).where(F.size("cores") > 1).select("doc_id")


def p10_pieces(spark, d):
    return chunking.pieces(table(spark, d, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_segments, p2_found, p2_normalised, p3_found, p3_report, p3_mix, p4_method, p4_found, p4_restored, p5_found, p5_splits, p5_report,
        p6_method, p6_found, p6_rates, p7_found, p7_counts, p8_sequences, p8_fills, p9_found, p9_clean, p10_found, p10_pieces,
    )
}

_REFERENCE = "coalesce(nullif(trim(messages[2].content), ''), nullif(trim(label), ''))"
_TRIGRAM = "list_concat(['^', '^'], list_filter(regexp_split_to_array(lower({}), ' +'), lambda w: w <> ''))"

# the rule of problem 7 on all pairs; letters beyond ASCII count as one character, as the engine of the SQL compares bytes
_SPELT = "array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda t: chr(list_position(v, t)::int)), '')"
_OVERLAPS = r"""
        e as (select entry_id, split_name, source, trim(regexp_replace(lower(messages[2].content), '[\s\p{Z}]+', ' ', 'g')) as text, images from chat_entries where split_name is not null),
        t as (select text, bool_or(split_name = 'train') as train, bool_or(split_name <> 'train') as held from e where length(text) >= 40 group by text),
        near as (select a.text as ta, b.text as tb, greatest(length(a.text), length(b.text)) as n from t a join t b on a.train and b.held and length(a.text) >= 0.9 * length(b.text) - 1 and length(b.text) >= 0.9 * length(a.text) - 1
            and (a.text = b.text or levenshtein(a.text, b.text) <= 0.3 * greatest(length(a.text), length(b.text)))),
        v as (select *, list_distinct(list_concat(regexp_extract_all(ta, '(?s).'), regexp_extract_all(tb, '(?s).'))) as v from near),
        same as (select ta, tb from v where ta = tb or levenshtein(SPELT_A, SPELT_B) <= floor(n * 0.1::double)),
        i as (select distinct entry_id, split_name, source, regexp_extract(regexp_replace(p, '[\\/]+(\.[\\/]+)*', '/', 'g'), '(^|/)(images/.*)$', 2) as key from (select entry_id, split_name, source, unnest(images) as p from e)),
        o as (select x.entry_id as a, y.entry_id as b, y.split_name as split_name, y.source as source, 'content' as kind from same s join e x on x.text = s.ta and x.split_name = 'train' join e y on y.text = s.tb and y.split_name <> 'train'
            union select x.entry_id, y.entry_id, y.split_name, y.source, 'image' from i x join i y on x.key = y.key and x.key <> '' and x.split_name = 'train' and y.split_name <> 'train')""".replace(
    "SPELT_A", _SPELT.format(x="ta")).replace("SPELT_B", _SPELT.format(x="tb"))

SQL = {
    "p7_found": f"with {_OVERLAPS} select distinct least(a, b) as entry_a, greatest(a, b) as entry_b from o",
    "p7_counts": f"with {_OVERLAPS} select split_name, source, kind, count(distinct b) as entries, count(*) as pairs from o group by split_name, source, kind",
    "p6_method": f"""
        with t as (select distinct {_TRIGRAM.format(_REFERENCE)} as w from eval_results where {_REFERENCE} is not null),
        g as (select unnest(list_transform(generate_series(3, len(w)), lambda i: {{'k': w[i - 2:i], 'inside': i < len(w)}})) as g from t),
        c as (select g.k as k, count(*) filter (where g.inside) as inside, count(*) filter (where not g.inside) as at_end from g group by g.k),
        a as (select result_id, {_TRIGRAM.format('answer')} as w from eval_results where answer is not null)
        select result_id, inside, at_end from a join c on c.k = w[-3:] where len(w) > 2 and inside >= 1 and at_end <= 0.02 * (inside + at_end)""",
    "p3_found": r"""
        with own as (select source, sum(length(text))::double as c from manifest where regexp_matches(text, '[^\s\p{Z}]') group by source),
        t as (select m.source, m.target_share, m.max_repeats, coalesce(o.c, 0) as c from mix_targets m left join own o on o.source = m.source)
        select source from t where max_repeats * c < target_share * (select sum(c) from t)""",
    "p5_found": r"""
        with k as (
            select rec_id, source, regexp_extract(file_name, '([0-9]{6,})', 1) as digits from manifest
            where source is not null and file_name is not null and not regexp_matches(file_name, '^(\./)*[0-9]+(\.(?i:png))?$')),
        i as (select rec_id, source, coalesce(nullif(ltrim(digits, '0'), ''), '0') as item from k where digits <> ''),
        g as (select rec_id, min(rec_id) over (partition by source, item) as group_rec_id, count(*) over (partition by source, item) as n from i)
        select rec_id, group_rec_id from g where n >= 2""",
}
