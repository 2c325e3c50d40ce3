"""JSON inside a model's prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockspark.functions.text import bind, col


def parses(c: Column) -> Column:
    """Whether the whole text is one JSON value; the parser alone stops after the first."""
    only = lambda h: h.isNotNull() & F.try_variant_get(h, "$[0]", "variant").isNotNull() & F.try_variant_get(h, "$[1]", "variant").isNull()
    return bind(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), only)


def _valid(c: Column) -> Column:
    return bind(c, lambda x: F.when(parses(x), x))


def elements_json(c: Column | str) -> Column:
    """The answer's JSON object: the greedy span around page_elements, else the first balanced object that parses; '' if none.

    Braces are counted without regard to strings, as one fold over the pieces between
    closing braces.
    """
    whole = lambda x: F.when(F.contains(x, F.lit('"page_elements"')) & parses(x) & F.array_contains(F.json_object_keys(x), "page_elements"), x)
    found = lambda text: F.coalesce(bind(_span(text), whole), F.get(F.filter(balanced(text), parses), F.lit(0)), F.lit(""))
    return bind(F.coalesce(col(c), F.lit("")), found)


def _span(text: Column) -> Column:
    """From the first opening to the last closing brace; null or '' if there is none."""
    start = F.instr(text, "{")
    return F.when(start > 0, F.substr(text, start, F.length(text) - F.length(F.substring_index(text, "}", -1)) - start + 1))


def balanced(text: Column) -> Column:
    """All outermost balanced {...} spans in order."""
    pieces = F.split(text, r"(?<=\})")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("held"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        opens = F.length(piece) - F.length(F.replace(piece, F.lit("{"), F.lit("")))
        closes = F.length(piece) - F.length(F.replace(piece, F.lit("}"), F.lit("")))
        held = F.when(acc["depth"] > 0, F.concat(acc["held"], piece)).when(opens > 0, F.regexp_extract(piece, r"(?s)\{.*", 0)).otherwise("")
        depth = acc["depth"] + opens - closes
        done = (depth == 0) & (held != "")
        return F.struct(
            F.greatest(depth, F.lit(0)).alias("depth"),
            F.when(depth > 0, held).otherwise("").alias("held"),
            F.when(done, F.concat(acc["out"], F.array(held))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(pieces, start, step, lambda a: a["out"])


def loose_json(c: Column | str) -> Column:
    """A response's JSON: as it is, from a fenced block, or an object nested once at most; null if none parses."""
    text = col(c)
    fenced = F.regexp_extract(text, r"(?s)`{3}(?:json|)[\s]*([{].*?[}])[\s]*`{3}", 1)
    nested = F.regexp_extract(text, r"(?s)[{][^{}]*(?:[{][^{}]*[}][^{}]*)*[}]", 0)
    return F.coalesce(_valid(text), _valid(F.nullif(fenced, F.lit(""))), _valid(F.nullif(nested, F.lit(""))))


def key_info(c: Column | str) -> Column:
    """The greedy {...} span if it parses, else an object that holds the raw text."""
    span = _valid(F.nullif(F.regexp_extract(col(c), r"(?s)\{.*\}", 0), F.lit("")))
    return F.coalesce(span, F.to_json(F.struct(col(c).alias("raw"))))


def caption_text(c: Column | str, type: Column | str) -> Column:
    """A structured caption as a sentence, by the kind of picture; the raw text if it is no JSON or says nothing."""
    raw, t = col(c), col(type)
    v = F.try_parse_json(loose_json(c))
    get = lambda path: F.nullif(F.try_variant_get(v, f"$.{path}", "string"), F.lit(""))
    items = lambda path, n: F.nullif(F.array_join(F.slice(F.coalesce(F.try_variant_get(v, f"$.{path}", "array<string>"), F.array().cast("array<string>")), 1, n), ", "), F.lit(""))
    join = lambda *parts: F.nullif(F.concat_ws(". ", *parts), F.lit(""))
    chart = join(F.concat(F.initcap(get("chart_type")), F.lit(" chart")), F.concat(F.lit("titled '"), get("title"), F.lit("'")), F.concat(F.lit("showing "), get("data_summary")))
    table = join(F.concat(F.lit("Table: "), get("title")), F.concat(F.nullif(get("row_count"), F.lit("0")), F.lit(" rows")), F.concat(F.lit("Columns: "), items("columns", 5)), get("summary"))
    figure = join(F.initcap(get("type")), get("description"), F.concat(F.lit("Key elements: "), items("key_elements", 3)))
    return F.coalesce(F.when(t == "chart", chart).when(t == "table", table).when(t == "figure", figure), raw)
