"""Fragments of the SQL statements that state the queries for another engine."""

WS = r"[\t-\r\x1C-\x1F\x{85}\p{Z}]"
NOT_WS = r"[^\t-\r\x1C-\x1F\x{85}\p{Z}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def some(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '{NOT_WS}'), false)"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def chars(x: str) -> str:
    return f"regexp_extract_all({x}, '(?s).')"


def distance(a: str, b: str, v: str = "v") -> str:
    """Edit distance by code point: each distinct character of the pair stands as one byte, as this engine compares bytes."""
    code = lambda x: f"array_to_string(list_transform({chars(x)}, lambda t: chr(list_position({v}, t)::int)), '')"
    return f"levenshtein({code(a)}, {code(b)})"


PAIRS = """p as (select result_id, entry_id, run_name, coalesce(source, 'unknown') as source, coalesce(answer, '') as pred,
    coalesce(nullif(label, ''), messages[2].content, '') as ref, images[1] as image from eval_results)"""
SCORED = f"""{PAIRS}, pv as (select *, list_distinct(list_concat({chars('pred')}, {chars('ref')})) as v from p),
    pd as (select *, {distance('pred', 'ref')} as d from pv),
    s as (select *, coalesce(d / nullif(greatest(length(pred), length(ref)), 0), 0)::double as ned,
        (case when length(ref) = 0 then (case when length(pred) = 0 then 0 else 1 end) else d / length(ref) end)::double as cer,
        ({strip('pred')} = {strip('ref')})::int as exact from pd)"""
