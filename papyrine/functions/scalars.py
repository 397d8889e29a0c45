"""Scalar functions as Columns: dates, strings, numbers, JSON. All are built-in expressions, so Catalyst folds and compiles
them; none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns (SQL LIKE, on lower case) and the institution code of the first that matches.
INSTITUTION_PATTERNS = (
    ("%ljubljan%", "UNI_LJ"),
    ("%brussel%", "VUB"),
    ("%dresden%", "TU_DRESDEN"),
    ("%gothenburg%", "GU"),
    ("%göteborgs%", "GU"),
    ("%cergy%", "CY"),
    ("%paris%", "CY"),
    ("%lisbon%", "UNL"),
    ("%nova%", "UNL"),
    ("%warwick%", "WARWICK"),
    ("%barcelona%", "UPF"),
    ("%pompeu%fabra%", "UPF"),
    ("%venice%", "UNIVE"),
    ("%foscari%", "UNIVE"),
    ("%babes%", "UBBCLUJ"),
    ("%bolyai%", "UBBCLUJ"),
)


def institution_code(text: Column, patterns: tuple[tuple[str, str], ...] = INSTITUTION_PATTERNS, other: str = "OTHER") -> Column:
    """the code of the first pattern that the lower-cased text matches; `other` if none does or the text is null."""
    lower = F.lower(text)
    chain = F.when(F.lit(False), F.lit(other))
    for pattern, code in patterns:
        chain = chain.when(lower.like(pattern), F.lit(code))
    return chain.otherwise(F.lit(other))


def clamped_date(year: Column, month: Column, day: Column, lift_day: bool = False) -> Column:
    """a date whose year is at least 1900, month at least 1 and day at most the month's last.

    With lift_day the day is at least 1 and null parts count as 1900, 1 and 1; without it a null part gives null and a day
    under 1 gives null. A month over 12 gives null.
    """
    if lift_day:
        year, month, day = (F.coalesce(c.cast("int"), F.lit(low)) for c, low in ((year, 1900), (month, 1), (day, 1)))
    y, m = F.greatest(year.cast("int"), F.lit(1900)), F.greatest(month.cast("int"), F.lit(1))
    first = F.try_make_timestamp(y, m, F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    d = F.least(day.cast("int"), F.dayofmonth(F.last_day(first)))
    if lift_day:
        d = F.greatest(d, F.lit(1))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull() & first.isNotNull() & (d >= 1), F.date_add(first, d - 1))


def exact_date(year: Column, month: Column, day: Column) -> Column:
    """A date of three parts; null if one is null or there is no such day."""
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def json_date(json: Column, lenient: bool = False) -> Column:
    """F16: the date of a JSON object with a `date-time`, a `timestamp` in milliseconds, or `date-parts`.

    Strict: that order, and all three parts are needed. Lenient: timestamp first, and a missing month or day counts as 1.
    Text that is no JSON, and values that are no dates, give null.
    """
    got = lambda path: F.get_json_object(json, path)
    moment = F.try_to_timestamp(F.substring(got("$['date-time']"), 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    millis = F.to_date(F.timestamp_seconds(F.floor(got("$.timestamp").try_cast("bigint") / 1000)))
    year, month, day = (got(f"$['date-parts'][0][{i}]").try_cast("int") for i in range(3))
    if lenient:
        parts = exact_date(year, F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))
        return F.coalesce(millis, moment, parts)
    return F.coalesce(moment, millis, exact_date(year, month, day))


def strip_quotes(text: Column) -> Column:
    """without straight and curly double quotes."""
    return F.translate(text, '”“"', "")


def keyword_list(text: Column) -> Column:
    """F8: a list of keywords from free text: outer blanks, all leading [ and closing ], and braces dropped, cut at commas,
    blanks trimmed, empty items dropped. Text with a line break inside gives an empty list, null gives null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^\[+|\]+$", ""), r"[{}]", "")
    items = F.filter(F.transform(F.split(bare, ","), lambda x: F.trim(x)), lambda x: x != "")
    broken = F.exists(items, lambda x: x.rlike(r"[\r\n]"))
    return F.when(broken, F.array().cast("array<string>")).otherwise(items)


def snake_case(text: Column) -> Column:
    """lower-case words joined by underscores; other characters are dropped."""
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(text, r"[^a-zA-Z0-9\s_]", "")), r"\s+", "_"))


def array_text(items: Column) -> Column:
    """an array as text, {a,"b c"}: items that are empty, read NULL or hold a blank, comma, brace, quote or backslash
    stand in quotes, with quotes and backslashes escaped."""
    quoted = lambda x: F.concat(F.lit('"'), F.regexp_replace(x, r'(["\\])', r"\\$1"), F.lit('"'))
    item = lambda x: F.when(x.isNull(), F.lit("NULL")).when(x.rlike(r'[\s,{}"\\]') | (x == "") | (F.upper(x) == "NULL"), quoted(x)).otherwise(x)
    return F.when(items.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(items, item), ","), F.lit("}")))


def truncated_quotient(a: Column, b: Column) -> Column:
    """the quotient cut towards zero, as a bigint."""
    q = a / b
    return F.when(q >= 0, F.floor(q)).otherwise(F.ceil(q)).cast("bigint")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """cosine similarity of two arrays; null if one is zero or null."""
    length = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(length > 0, dot(a, b) / length)


def unit(a: Column) -> Column:
    """an array scaled to length one; null if it is zero."""
    length = F.sqrt(dot(a, a))
    return F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length))


def mean_pool(vectors: Column, mask: Column) -> Column:
    """the mean of those vectors (array of arrays) whose mask is 1; null if there is none."""
    kept = F.transform(F.filter(F.arrays_zip(vectors.alias("v"), mask.alias("m")), lambda x: x["m"] == 1), lambda x: x["v"])
    total = F.aggregate(F.slice(kept, 2, F.greatest(F.size(kept) - 1, F.lit(0))), F.get(kept, F.lit(0)), lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    return F.when(F.size(kept) > 0, F.transform(total, lambda x: x / F.size(kept)))


def json_text(json: Column, key: str) -> Column:
    """A member of a JSON object as text; null if absent, null or the text is no JSON."""
    return F.get_json_object(json, f"$['{key}']")


def json_items(json: Column) -> Column:
    """The elements of a JSON list as an array of JSON texts. A bare object is a list of one; null, a scalar or
    text that is no JSON is null."""
    listed = F.from_json(json, "array<string>")
    return F.when(F.substring(F.ltrim(json), 1, 1) == "[", listed).when((F.substring(F.ltrim(json), 1, 1) == "{") & F.get_json_object(json, "$").isNotNull(), F.array(json))


def readable(json: Column) -> Column:
    """A JSON text as it is, the content of a JSON string that holds JSON, or null if neither is complete JSON."""
    parsed = F.try_parse_json(json)
    inner = F.try_variant_get(parsed, "$", "string")
    is_text = F.schema_of_variant(parsed) == "STRING"
    return F.when(parsed.isNull(), None).when(is_text, F.when(F.try_parse_json(inner).isNotNull(), inner)).otherwise(json)


def wrapped(json: Column, key: str) -> Column:
    """The member `key` that wraps a document in some versions, else the document."""
    return F.coalesce(F.get_json_object(json, f"$.{key}"), json)
