"""Ingest, naming, chat and text-quality queries."""

from pyspark.sql import functions as F

from corpusforge.catalog import query
from corpusforge.functions import text as T
from corpusforge.operators import corruption as C
from corpusforge.operators import records as R
from corpusforge.plans.sqltext import some, strip, words
from corpusforge.runtime import fresh_dir, spread, table
from corpusforge.sources import readers


def _m(spark, d):
    return table(spark, d, "manifest")


FLAT = "case when contains(file_name, '/') then string_split(file_name, '/')[1] || '_' || string_split(file_name, '/')[-1] else file_name end"


@query("E1 P1 P2 P3 P20", f"select source, file_name, {strip('text')} as text, type, image.path as path from manifest where {some('text')}")
def manifest_normalise(spark, d):
    return R.conform(_m(spark, d)).select("source", "file_name", "text", "type", F.col("image.path").alias("path"))


@query("P2", f"select source, count(*) as n from manifest where {some('text')} group by source")
def blank_text_filter(spark, d):
    return _m(spark, d).where(~T.is_blank(F.col("text"))).groupBy("source").agg(F.count("*").alias("n"))


@query("P1", "select rec_id, text as t, file_name as f from manifest")
def column_autodetect(spark, d):
    m = _m(spark, d)
    return m.select("rec_id", F.col(R.detected(m, R.TEXT_COLUMNS)).alias("t"), F.col(R.detected(m, R.NAME_COLUMNS)).alias("f"))


@query("P4", "select rec_id, case when n like '%.png' then n else n || '.png' end as name from (select rec_id, coalesce(file_name, repeat('0', greatest(0, 8 - length(rec_id::varchar))) || rec_id::varchar) as n from manifest)")
def png_suffix_names(spark, d):
    return _m(spark, d).select("rec_id", R.image_name(F.col("file_name"), F.col("rec_id")).alias("name"))


@query("P5 F19", f"select rec_id, {FLAT} as name from manifest")
def flatten_path_names(spark, d):
    return _m(spark, d).select("rec_id", R.flat_name(F.col("file_name")).alias("name"))


@query("P6", r"""with s as (select rec_id, regexp_replace(regexp_replace(file_name, '^.*/', ''), '^(.+)\.[^.]*$', '\1') as stem from manifest),
    q as (select rec_id, case when len(string_split(stem, '_')) >= 3 then string_split(stem, '_')[3] else stem end as prefix from s)
    select rec_id, case when prefix is null or prefix = '' or starts_with('p1_page.png', prefix || '_') then 'p1_page.png' else prefix || '_p1_page.png' end as name from q""")
def pdf_id_names(spark, d):
    return _m(spark, d).select("rec_id", R.page_image_name(F.col("file_name"), F.lit("p1_page.png")).alias("name"))


@query("P20", "select rec_id, case when contains(text, chr(10)) then 'paragraph' else 'text_line' end as kind from manifest")
def type_tagging(spark, d):
    return _m(spark, d).select("rec_id", R.kind_of(F.col("text")).alias("kind"))


@query("P22", "select source, case when n < 1000 then 'n<1K' when n < 10000 then '1K<n<10K' when n < 100000 then '10K<n<100K' else '100K<n<1M' end as size from (select source, count(*) as n from manifest group by source)")
def size_category(spark, d):
    return _m(spark, d).groupBy("source").agg(F.count("*").alias("n")).select("source", R.size_class(F.col("n")).alias("size"))


@query("P7 L7", f"select rec_id, '<image>OCR:' as prompt, text as answer, './images/' || {FLAT} as image from manifest where {some('text')}")
def chat_entries_build(spark, d):
    c = R.chat_entries(_m(spark, d))
    return c.select("rec_id", F.get("messages", F.lit(0))["content"].alias("prompt"), F.get("messages", F.lit(1))["content"].alias("answer"), F.get("images", F.lit(0)).alias("image"))


@query("F28", """select entry_id, array_to_string(list_transform(messages, lambda m: case when m.role = 'user' then 'User: ' || m.content || chr(10) || 'Assistant:' || chr(10) else coalesce(m.content, '') end), '') as prompt from chat_entries""")
def prompt_template_render(spark, d):
    return table(spark, d, "chat_entries").select("entry_id", T.rendered(F.col("messages")).alias("prompt"))


@query("F27", """select entry_id, replace(messages[1].content, '<image>', '<|begin|>' || repeat('<|tok|>', (entry_id % 7 + 1)::int) || '<|end|>') as text from chat_entries""")
def placeholder_expand(spark, d):
    return table(spark, d, "chat_entries").select("entry_id", T.expanded(F.get("messages", F.lit(0))["content"], (F.col("entry_id") % 7 + 1).cast("int")).alias("text"))


TRUTHY = "coalesce(nullif(answer, ''), nullif(label, ''), messages[2].content, '')"


@query("P12", f"select result_id, {TRUTHY} as text from eval_results where length({strip(TRUTHY)}) > 50")
def first_truthy_text(spark, d):
    t = F.coalesce(F.nullif("answer", F.lit("")), F.nullif("label", F.lit("")), F.get("messages", F.lit(1))["content"], F.lit(""))
    return table(spark, d, "eval_results").select("result_id", t.alias("text")).where(F.length(T.strip(F.col("text"))) > 50)


SYMBOLS = r"[0-9!@#$%^&*()_+\-=\[\]{}|;:''\",.<>?/\\`~]"
SHARE = f"len(regexp_extract_all(text, '{SYMBOLS}'))::double / nullif(length(text), 0)"


@query("P11 F18", f"select rec_id, round({SHARE}, 6) as share from manifest")
def symbol_ratio(spark, d):
    return _m(spark, d).select("rec_id", F.round(T.symbol_share(F.col("text")), 6).alias("share"))


@query("P11 S16", f"select doc_id from documents where length(text) >= 50 and {SHARE} <= 0.5")
def valid_text_filter(spark, d):
    return table(spark, d, "documents").where(T.valid_corpus_text(F.col("text"))).select("doc_id")


@query("Q16 F7", "select source, count(*) as n from documents where length(text) <= 1200 group by source")
def char_limit_filter(spark, d):
    return table(spark, d, "documents").where(F.length("text") <= 1200).groupBy("source").agg(F.count("*").alias("n"))


@query("F9", "select rec_id, translate(text, 'åäöéüšžÅÄÖÉÜŠŽ', 'aaoeuszAAOEUSZ') as text from manifest")
def diacritic_fold(spark, d):
    return _m(spark, d).select("rec_id", C.fold_diacritics(F.col("text")).alias("text"))


def _hash_sql(*what):
    return f"(('0x' || substr(md5(concat_ws('|', rec_id::varchar, {', '.join(what)})), 1, 8))::bigint / 4294967296.0)"


def _per_char_sql(change):
    return f"select rec_id, array_to_string(list_transform(regexp_extract_all(text, '(?s).'), lambda c, i: {change}), '') as text from manifest"


@query("F12", _per_char_sql(f"case when {_hash_sql(chr(39) + 'c' + chr(39), '(i - 1)::varchar')} < 0.03 then (case when c = upper(c) then lower(c) else upper(c) end) else c end"))
def case_noise(spark, d):
    return spread(_m(spark, d)).select("rec_id", C.case_noise(F.col("text"), F.col("rec_id").cast("string"), F.lit(0.03)).alias("text"))


@query("F13", _per_char_sql(f"case when regexp_matches(c, '^[0-9]$') and {_hash_sql(chr(39) + 'g' + chr(39), '(i - 1)::varchar')} < 0.05 then floor({_hash_sql(chr(39) + 'w' + chr(39), '(i - 1)::varchar')} * 10)::int::varchar else c end"))
def digit_swap(spark, d):
    return spread(_m(spark, d)).select("rec_id", C.digit_swap(F.col("text"), F.col("rec_id").cast("string"), F.lit(0.05)).alias("text"))


@query("F9", _per_char_sql(f"case when {_hash_sql(chr(39) + 'd' + chr(39), '(i - 1)::varchar')} < 0.6 then translate(c, 'åäöéüšžÅÄÖÉÜŠŽ', 'aaoeuszAAOEUSZ') else c end"))
def diacritic_swap(spark, d):
    return spread(_m(spark, d)).select("rec_id", C.diacritic_swap(F.col("text"), F.col("rec_id").cast("string"), F.lit(0.6)).alias("text"))


_LETTER = f"substr('{C.NOISE}', floor({_hash_sql(chr(39) + 'l' + chr(39), '(i - 1)::varchar')} * {len(C.NOISE)})::int + 1, 1)"
_NOISE = _hash_sql(chr(39) + "n" + chr(39), "(i - 1)::varchar")


@query("F11", _per_char_sql(f"case when {_NOISE} < 0.03::double * 0.4 then {_LETTER} when {_NOISE} < 0.03::double * 0.55 then {_LETTER} || c when {_NOISE} < 0.03 then '' else c end"))
def char_noise(spark, d):
    return spread(_m(spark, d)).select("rec_id", C.char_noise(F.col("text"), F.col("rec_id").cast("string"), F.lit(0.03)).alias("text"))


def _confuse_sql(p):
    rows = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(C.CONFUSIONS))
    u = _hash_sql(chr(39) + "o" + chr(39), "i::varchar")
    first = "{'t': text, 'k': 0, 'a': '', 'b': '', 'u': 1.0::double}"
    hit = f"acc.k < {C.MOST_CONFUSIONS} and contains(acc.t, c.a) and c.u < {p}"
    put = "substr(acc.t, 1, strpos(acc.t, c.a) - 1) || c.b || substr(acc.t, strpos(acc.t, c.a) + length(c.a))"
    return f"""with f(i, a, b) as (values {rows}),
        o as (select rec_id, list({{'t': '', 'k': 0, 'a': a, 'b': b, 'u': {u}::double}} order by md5(concat_ws('|', rec_id::varchar, 's', i::varchar)), i) as l from (select rec_id from manifest where text is not null) m, f group by rec_id)
        select m.rec_id, case when text is null then null else list_reduce(list_prepend({first}, l), lambda acc, c: {{'t': case when {hit} then {put} else acc.t end, 'k': case when {hit} then acc.k + 1 else acc.k end, 'a': c.a, 'b': c.b, 'u': c.u}}).t end as text
        from manifest m left join o on o.rec_id = m.rec_id"""


@query("F10", _confuse_sql(0.15))
def ocr_confuse(spark, d):
    return spread(_m(spark, d)).select("rec_id", C.confuse(F.col("text"), F.col("rec_id").cast("string"), F.lit(0.15)).alias("text"))


@query("F14 F15")
def synthetic_rejected(spark, d):
    m = spread(_m(spark, d)).where(~T.is_blank(F.col("text"))).select("rec_id", "text")
    return C.variants(m, "text", "rec_id", 2).select("rec_id", "variant", "rejected")


@query("F17", f"""select rec_id, case when text is null then null when len({words('text')}) = 0 then '' else list_reduce({words('text')}, lambda a, w: case when length(string_split(a, chr(10))[-1]) + 1 + length(w) <= 45 + rec_id % 36 then a || ' ' || w else a || chr(10) || w end) end as text from manifest""")
def word_wrap_greedy(spark, d):
    return _m(spark, d).select("rec_id", T.wrapped(F.col("text"), (F.pmod("rec_id", F.lit(36)) + 45).cast("int")).alias("text"))


@query("F6", f"select rec_id, len({words('text')})::bigint as n from manifest where text is not null")
def word_counts(spark, d):
    return _m(spark, d).where("text is not null").select("rec_id", F.size(T.words(F.col("text"))).cast("bigint").alias("n"))


@query("F8", "select rec_id, round(('0x' || substr(md5(file_name), 1, 13))::bigint / 4503599627370496.0, 9) as u from manifest")
def det_hash(spark, d):
    return _m(spark, d).select("rec_id", F.round(T.unit_hash(F.col("file_name")), 9).alias("u"))


@query("S6 S7 K3 F22", "select event_id, event_type, 1::bigint as fields from events where event_id % 50 <> 0")
def jsonl_tolerant_scan(spark, d):
    """Events written as JSON lines, every fiftieth broken off, blank lines between, and read again without the broken ones."""
    e = table(spark, d, "events").select("event_id", "event_type")
    line = F.to_json(F.struct("*"))
    lines = e.select(F.explode(F.array(F.when(F.col("event_id") % 50 == 0, F.left(line, F.lit(12))).otherwise(line), F.lit("  "))).alias("value"))
    path = fresh_dir(spark, "lines") + "/events.jsonl"
    lines.write.text(path)
    good, _ = readers.json_tolerant(spark, path, e.schema)
    return good.select("event_id", "event_type", F.lit(1).cast("bigint").alias("fields"))


@query("S15", r"select file_name as name, regexp_replace(text, '[\r\n]', ' ', 'g') as text from manifest where file_name is not null and text is not null")
def tsv_scan(spark, d):
    """A TSV list written and read again; lines without a tab are no records."""
    flat = F.regexp_replace("text", r"[\r\n]", " ")
    lines = _m(spark, d).where("file_name is not null").select(F.when(F.col("text").isNull(), F.col("file_name")).otherwise(F.concat("file_name", F.lit("\t"), flat)).alias("value"))
    path = fresh_dir(spark, "list") + "/list.tsv"
    lines.write.text(path)
    return readers.tsv_list(spark, path).select(F.col("file_name").alias("name"), "text")


@query("P25", "select rec_id, '/bitstream/handle/' || file_name || '.PDF?sequence=1' as link from manifest where file_name is not null")
def first_matching_link(spark, d):
    m = _m(spark, d).where("file_name is not null")
    html = F.concat(F.lit('<a href="/x"></a><a href="/bitstream/handle/'), F.col("file_name"), F.lit('.PDF?sequence=1&isAllowed=y">'))
    return m.select("rec_id", R.first_link(html).alias("link"))


@query("F26 F30", r"""select rec_id, 'https' as scheme, 'x.org' as host, regexp_replace(file_name, '^.*/', '') as last, 'theseus_' || rec_id || '.pdf' as pdf from manifest where file_name is not null""")
def url_parts(spark, d):
    m = _m(spark, d).where("file_name is not null")
    url = F.concat(F.lit("https://x.org/a/"), F.col("file_name"))
    handle = F.concat(F.lit("http://x/handle/10024/"), F.col("rec_id").cast("string"), F.lit("/"))
    return m.select("rec_id", *T.url_parts(url), R.handle_pdf_name(handle).alias("pdf"))


@query("S12", r"""with h as (select rec_id, unnest(list_filter(regexp_extract_all('<dc:identifier>http://x/handle/' || rec_id || '</dc:identifier><dc:identifier>' || coalesce(source, '') || '</dc:identifier>', '<dc:identifier>([^<]*)</dc:identifier>', 1), lambda x: contains(x, '/handle/'))) as handle from manifest) select rec_id, handle from h""")
def all_links_explode(spark, d):
    xml = F.concat(F.lit("<dc:identifier>http://x/handle/"), F.col("rec_id").cast("string"), F.lit("</dc:identifier><dc:identifier>"), F.coalesce("source", F.lit("")), F.lit("</dc:identifier>"))
    return _m(spark, d).select("rec_id", F.explode(R.handles(xml)).alias("handle"))
