import datetime as dt

from pyspark.sql import functions as F

from papyrine.functions.scalars import array_text, clamped_date, cosine, institution_code, json_date, json_items, keyword_list, mean_pool, readable, snake_case, strip_quotes, truncated_quotient, unit, wrapped


def value(spark, column, **values):
    types = {str: "string", int: "int", float: "double", list: "array<string>"}
    fields = ", ".join(f"{k} {types.get(type(v), 'string')}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], fields).select(column.alias("v")).first()["v"]


def test_institution_code(spark):
    code = lambda t: value(spark, institution_code(F.col("t")), t=t)
    assert code("University of LJUBLJANA") == "UNI_LJ"
    assert code("Göteborgs universitet") == "GU"
    assert code("Dresden and Paris") == "TU_DRESDEN"  # the first pattern counts
    assert code("Pompeu i Fabra") == "UPF"
    assert code("elsewhere") == code(None) == "OTHER"


def test_dates(spark):
    f = lambda y, m, d, lift=False: value(spark, clamped_date(F.col("y"), F.col("m"), F.col("d"), lift), y=y, m=m, d=d)
    assert f(2021, 4, 31) == dt.date(2021, 4, 30)
    assert f(2020, 2, 30) == dt.date(2020, 2, 29)
    assert f(1700, 0, 5) == dt.date(1900, 1, 5)
    assert f(2020, 5, 0) is None and f(2020, 5, 0, True) == dt.date(2020, 5, 1)
    assert f(2020, 13, 1) is None
    null = lambda lift: spark.sql("select cast(null as int) y, 1 m, 1 d").select(clamped_date(F.col("y"), F.col("m"), F.col("d"), lift)).first()[0]
    assert null(False) is None and null(True) == dt.date(1900, 1, 1)


def test_json_dates(spark):
    f = lambda j, lenient=False: value(spark, json_date(F.col("j"), lenient), j=j)
    both = '{"timestamp": 86400000, "date-time": "2020-01-02T00:00:00Z"}'
    assert f(both) == dt.date(2020, 1, 2) and f(both, True) == dt.date(1970, 1, 2)
    assert f('{"date-parts": [[2020, 5]]}') is None and f('{"date-parts": [[2020, 5]]}', True) == dt.date(2020, 5, 1)
    assert f('{"date-parts": [[2020, 13, 1]]}') is None and f("no json") is None and f(None) is None and f("{}") is None


def test_keyword_list(spark):
    f = lambda t: value(spark, keyword_list(F.col("t")), t=t)
    assert f("[[a, b,, c ]]") == ["a", "b", "c"]
    assert f("{a}, {b}") == ["a", "b"]
    assert f("a, b\nc") == [] and f("") == [] and f(None) is None


def test_strings(spark):
    assert value(spark, strip_quotes(F.col("t")), t="“a”\"b\"") == "ab"
    assert value(spark, snake_case(F.col("t")), t="  Two  Words (x) ") == "two_words_x"
    items = F.array(F.lit("a"), F.lit("b c"), F.lit(""), F.lit("null"), F.lit('q"\\'), F.lit(None), F.lit("x,y"))
    assert value(spark, array_text(items)) == '{a,"b c","","null","q\\"\\\\",NULL,"x,y"}'
    assert value(spark, array_text(F.array().cast("array<string>"))) == "{}"


def test_numbers(spark):
    q = lambda a, b: value(spark, truncated_quotient(F.lit(a), F.lit(b)))
    assert (q(-7.0, 2.0), q(7.0, 2.0), q(0.5, 1.0)) == (-3, 3, 0)
    a, zero = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(0.0), F.lit(0.0))
    assert value(spark, cosine(a, a)) == 1.0 and value(spark, cosine(a, zero)) is None
    assert value(spark, unit(a)) == [0.6, 0.8] and value(spark, unit(zero)) is None
    rows = F.array(a, zero, F.array(F.lit(1.0), F.lit(0.0)))
    assert value(spark, mean_pool(rows, F.array(F.lit(1), F.lit(0), F.lit(1)))) == [2.0, 2.0]
    assert value(spark, mean_pool(rows, F.array(F.lit(0), F.lit(0), F.lit(0)))) is None


def test_json(spark):
    items = lambda j: value(spark, json_items(F.col("j")), j=j)
    assert items('[{"a":1},null]') == ['{"a":1}', None]
    assert items('{"a":1}') == ['{"a":1}'] and items("[]") == []
    assert items('"text"') is None and items("{broken") is None and items(None) is None
    r = lambda j: value(spark, readable(F.col("j")), j=j)
    assert r('{"a":1}') == '{"a":1}' and r('"{\\"a\\":1}"') == '{"a":1}'
    assert r('{"a":') is None and r('"plain"') is None and r("") is None and r(None) is None
    assert value(spark, wrapped(F.col("j"), "message"), j='{"message":{"a":1}}') == '{"a":1}'
    assert value(spark, wrapped(F.col("j"), "message"), j='{"message":null,"b":2}') == '{"message":null,"b":2}'
