"""Queries of the parsers, rules, text functions and page extraction, over texts derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import parse, rules, text
from terrane.operators import extract
from terrane.plans.facts import round_sql
from terrane.plans.registry_type import Query
from terrane.sources.listings import landed, snake_case, table


def _decoded(x: str) -> str:
    """A page's text in SQL: these four references stand for their characters, also without the semicolon, as in HTML."""
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&(?:{name}|{name.upper()});?', '{character}', 'g')"
    return x


QUERIES: list[Query] = []

#: Forms of price and area texts; the first % is a whole number, the second a number below 1000.
_PRICE_FORMS = ["%s tỷ", "%s,5 tỷ", "%s triệu/tháng", "%s.25 tỷ %s triệu", "Thỏa thuận", "%s nghìn", "%s00", "%s.01 tỷ", "%s trieu", "giá %s tr", "%s.200.000 đ", ""]
_AREA_FORMS = ["%s m2", "%s,5m²", "1.%s", "%s", "%s.75", "1.234,%s m2", "1,2%s.5", "%s 000 m2", "không rõ", "", "0"]


def _formed(forms: list[str]) -> str:
    """SQL of both engines: a text in one of the forms, by line number and order."""
    cases = []
    for i, f in enumerate(forms):
        parts = f.split("%s")
        value = " || ".join(x for j, p in enumerate(parts) for x in ((["CAST(q AS STRING)"] if j == 1 else ["CAST(m AS STRING)"] if j == 2 else []) + [f"'{p}'"]))
        cases.append(f"WHEN {i} THEN {value}")
    return f"CASE k % {len(forms)} {' '.join(cases)} END"


def _texts_sql(forms: list[str]) -> str:
    base = "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_quantity AS INTEGER) AS q, CAST(l_partkey % 1000 AS INTEGER) AS m, l_orderkey + l_linenumber AS k, l_extendedprice, l_returnflag FROM lineitem"
    return f"SELECT *, {_formed(forms).replace('STRING', 'VARCHAR')} AS x FROM ({base})"


def _texts(spark: SparkSession, d: str, forms: list[str]) -> DataFrame:
    line = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "CAST(l_quantity AS INT) AS q", "CAST(l_partkey % 1000 AS INT) AS m", "l_orderkey + l_linenumber AS k", "l_extendedprice", "l_returnflag",
    )
    return line.withColumn("x", F.expr(_formed(forms)))


_N = r"[-+]?\d*[.,]\d+|\d+"
_P = r"\d+(?:[.,]\d+)?"


def _num(x: str, pattern: str = _N, kind: str = "DOUBLE") -> str:
    return f"TRY_CAST(nullif(replace(regexp_extract({x}, '{pattern}', 0), ',', '.'), '') AS {kind})"


_FOLD = "replace(replace(strip_accents(x), 'đ', 'd'), 'Đ', 'D')"
_F = f"lower({_FOLD})"
_UNITS = "CASE WHEN lower(x) LIKE '%tỷ%' THEN 1000000000.0::DOUBLE WHEN lower(x) LIKE '%triệu%' THEN 1000000.0::DOUBLE WHEN lower(x) LIKE '%ngàn%' OR lower(x) LIKE '%nghìn%' THEN 1000.0::DOUBLE"
_DEC = "DECIMAL(24,6)"
_PRICE_SQL = {
    "unit_needed": f"CAST(trunc({_num('lower(x)')} * ({_UNITS} WHEN lower(x) LIKE '%đ%' OR lower(x) LIKE '%vnd%' THEN 1.0::DOUBLE END)) AS BIGINT)",
    "unit_optional": f"CASE WHEN lower(x) LIKE '%thỏa thuận%' THEN 0 ELSE CAST(trunc({_num('lower(x)')} * ({_UNITS} ELSE 1.0::DOUBLE END)) AS BIGINT) END",
    "plain_or_unit": f"""CASE WHEN lower(x) LIKE '%thương lượng%' OR lower(x) LIKE '%thỏa thuận%' THEN NULL
        WHEN regexp_full_match(replace(trim(lower(x)), ',', '.'), '[0-9]+([.][0-9]+)?') THEN TRY_CAST(replace(trim(lower(x)), ',', '.') AS DOUBLE)
        ELSE TRY_CAST(nullif(regexp_extract(replace(trim(lower(x)), ',', '.'), '[0-9.]+', 0), '') AS DOUBLE) * ({_UNITS} ELSE 1.0::DOUBLE END) END""",
    "plain_or_unit_dots": f"""CASE WHEN lower(x) LIKE '%thương lượng%' OR lower(x) LIKE '%thỏa thuận%' THEN NULL
        WHEN regexp_full_match(trim(lower(x)), '[0-9]+([.][0-9]+)?') THEN TRY_CAST(trim(lower(x)) AS DOUBLE)
        ELSE TRY_CAST(nullif(regexp_extract(trim(lower(x)), '[0-9.]+', 0), '') AS DOUBLE) * ({_UNITS} ELSE 1.0::DOUBLE END) END""",
    "folded": f"""CAST(floor(CASE WHEN {_F} LIKE '%ty%' THEN {_num(_F, _P, _DEC)} * 1000000000 WHEN {_F} LIKE '%trieu%' THEN {_num(_F, _P, _DEC)} * 1000000
        WHEN {_F} LIKE '%nghin%' OR {_F} LIKE '%ngan%' THEN {_num(_F, _P, _DEC)} * 1000 END) AS BIGINT)""",
    "compound": f"""CAST(floor(CASE WHEN {_F} LIKE '%ty%' THEN CASE WHEN {_num(f"split_part({_F}, 'ty', 1)", _P, _DEC)} IS NOT NULL OR (substr({_F}, instr({_F}, 'ty') + 2) LIKE '%trieu%' AND {_num(f"substr({_F}, instr({_F}, 'ty') + 2)", _P, _DEC)} IS NOT NULL)
          THEN coalesce({_num(f"split_part({_F}, 'ty', 1)", _P, _DEC)} * 1000000000, 0) + coalesce(CASE WHEN substr({_F}, instr({_F}, 'ty') + 2) LIKE '%trieu%' THEN {_num(f"substr({_F}, instr({_F}, 'ty') + 2)", _P, _DEC)} * 1000000 END, 0) END
        WHEN {_F} LIKE '%trieu%' THEN {_num(_F, _P, _DEC)} * 1000000 WHEN {_F} LIKE '%nghin%' OR {_F} LIKE '%ngan%' THEN {_num(_F, _P, _DEC)} * 1000 END) AS BIGINT)""",
    "two_units": f"""CASE WHEN x LIKE '%tỷ%' THEN CAST({_num('x', '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')} AS DECIMAL(15,2)) * 1000000000
          + CASE WHEN x LIKE '%triệu%' THEN {_num("list_last(string_split(x, 'tỷ'))", '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')} * 1000000 ELSE 0 END
        WHEN x LIKE '%triệu%' THEN {_num('x', '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')} * 1000000
          + CASE WHEN x LIKE '%nghìn%' OR x LIKE '%ngàn%' THEN {_num("list_last(string_split(x, 'triệu'))", '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')} * 1000 ELSE 0 END END""",
    "short_units": """nullif(CASE WHEN TRUE THEN TRY_CAST(nullif(regexp_extract(replace(replace(lower(x), ' ', ''), ',', '.'), '\\d+(?:\\.\\d+)?', 0), '') AS DECIMAL(24,6))
        * CASE WHEN regexp_matches(replace(lower(x), ' ', ''), 'ty|tỷ') THEN 1000000000 WHEN regexp_matches(replace(lower(x), ' ', ''), 'trieu|triệu|tr') THEN 1000000
          WHEN regexp_matches(replace(lower(x), ' ', ''), 'nghin|nghìn|ngan|k') THEN 1000 ELSE 1 END END, 0)""",
    "digits": "CASE WHEN regexp_full_match(x, '[0-9]+') THEN TRY_CAST(x AS BIGINT) END",
    "stripped": "TRY_CAST(nullif(regexp_replace(x, '[^0-9.]', '', 'g'), '') AS DOUBLE)",
}
for _name, _sql in _PRICE_SQL.items():
    QUERIES.append(Query(
        f"price_{_name}",
        lambda spark, d, n=_name: _texts(spark, d, _PRICE_FORMS).select("x", parse.PRICES[n](F.col("x")).cast("double").alias("price")).groupBy("x", "price").agg(F.count("*").alias("n")),
        f"SELECT x, CAST({_sql} AS DOUBLE) AS price, count(*) AS n FROM ({_texts_sql(_PRICE_FORMS)}) GROUP BY ALL",
    ))

_T_LAST = "nullif(regexp_extract(regexp_replace(lower(x), 'm²|m2|㎡', '', 'g'), '[-+]?\\d[\\d.,]*', 0), '')"
_T_FIRST = "nullif(regexp_replace(regexp_extract(x, '\\d[\\d\\s.,]*', 0), '\\s+', '', 'g'), '')"


def _signs_sql(t: str, last: bool) -> str:
    comma = f"length(list_last(string_split({t}, ','))) < length(list_last(string_split({t}, '.')))" if last else f"instr({t}, '.') < instr({t}, ',')"
    return f"""CASE WHEN contains({t}, '.') AND contains({t}, ',') THEN CASE WHEN {comma} THEN replace(replace({t}, '.', ''), ',', '.') ELSE replace({t}, ',', '') END
      WHEN contains({t}, '.') THEN CASE WHEN regexp_full_match({t}, '\\d{{1,3}}(\\.\\d{{3}})+') THEN replace({t}, '.', '') ELSE {t} END
      WHEN contains({t}, ',') THEN CASE WHEN regexp_full_match({t}, '\\d{{1,3}}(,\\d{{3}})+') THEN replace({t}, ',', '') ELSE replace({t}, ',', '.') END ELSE {t} END"""


def _pos(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {x} END"


_STRICT = "CASE WHEN regexp_full_match(replace(trim(x), ',', '.'), '[0-9]+(\\.[0-9]+)?') THEN CAST(replace(trim(x), ',', '.') AS DECIMAL(28,8)) END"
_AREA_SQL = {
    "first_number": _pos(_num("lower(x)")),
    "last_sign": _pos(f"TRY_CAST({_signs_sql(_T_LAST, True)} AS DOUBLE)"),
    "first_sign": f"TRY_CAST({_signs_sql(_T_FIRST, False)} AS {_DEC})",
    "strict": _pos(f"round({_STRICT}, 2)"),
    "strict4": _pos(f"round({_STRICT}, 4)"),
    "short": f"""CASE WHEN length(replace(regexp_extract(x, '[0-9]+([.,][0-9]+)?', 0), ',', '.')) <= 8 THEN round({_num('x', '[0-9]+([.,][0-9]+)?', _DEC)}, 2) END""",
}
for _name, _sql in _AREA_SQL.items():
    QUERIES.append(Query(
        f"area_{_name}",
        lambda spark, d, n=_name: _texts(spark, d, _AREA_FORMS).select("x", parse.AREAS[n](F.col("x")).cast("double").alias("area")).groupBy("x", "area").agg(F.count("*").alias("n")),
        f"SELECT x, CAST({_sql} AS DOUBLE) AS area, count(*) AS n FROM ({_texts_sql(_AREA_FORMS)}) GROUP BY ALL",
    ))


def _categories(g: rules.Groups) -> list[str]:
    return [*g.houses, *g.flats, *g.land, *(g.others or ()), "khác"]


def _pick(values: list[str], index: str) -> str:
    return f"CASE {index} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_SIDES_FORMS = ["%s m2 (4x%s)", "%s m2", "90 (%s,5x%s)", "(%s.25 X 18)", "(x3)", "%s (4x%s)x", ""]
_PHRASES = lambda c, phrases, default: "CASE " + " ".join("WHEN " + " OR ".join(f"contains({c}, '{n.lower()}')" for n in names) + f" THEN {v}" for names, v in phrases) + f" ELSE {default} END"
_KINDS = [*rules.SALE_NAMES, "Phòng trọ, nhà trọ", "Văn phòng", "Nhà xưởng, kho bãi", "Đất lâm nghiệp", "Nhà hàng", "khác"]
_PAPERS = ["Sổ hồng", "đã có sổ", "HĐMB", "Đang chờ sổ", "giấy tờ hợp lệ", "không"]
_TRADES = ["mua", "bán", "thuê", "khác"]

QUERIES += [
    Query(
        "area_sides",
        lambda spark, d: _texts(spark, d, _SIDES_FORMS).select("x", parse.area_sides(F.col("x")).alias("s")).select("x", F.col("s.width").cast("double").alias("width"), F.col("s.length").cast("double").alias("length")).groupBy("x", "width", "length").agg(F.count("*").alias("n")),
        "SELECT x, CAST(replace(nullif(regexp_extract(x, '\\(\\s*([0-9]+(?:[.,][0-9]+)?)\\s*[xX]\\s*([0-9]+(?:[.,][0-9]+)?)\\s*\\)', 1), ''), ',', '.') AS DOUBLE) AS width, CAST(replace(nullif(regexp_extract(x, '\\(\\s*([0-9]+(?:[.,][0-9]+)?)\\s*[xX]\\s*([0-9]+(?:[.,][0-9]+)?)\\s*\\)', 2), ''), ',', '.') AS DOUBLE) AS length, count(*) AS n "
        f"FROM ({_texts_sql(_SIDES_FORMS)}) GROUP BY ALL",
    ),
    Query(
        "price_residue",
        lambda spark, d: _texts(spark, d, _PRICE_FORMS).select("x", parse.price_residue(F.col("x"), F.lit(7).cast("decimal(28,2)")).cast("double").alias("price")).groupBy("x", "price").agg(F.count("*").alias("n")),
        f"""SELECT x, CAST(CASE WHEN x LIKE '%tỷ%' THEN {_num('x', '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')} * 1000000000
          + CASE WHEN x LIKE '%triệu%' THEN coalesce({_num("list_last(string_split(x, 'tỷ'))", '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')}, 0) * 1000000 ELSE 0 END
          WHEN x LIKE '%triệu%' THEN {_num('x', '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')} * 1000000 + CASE WHEN x LIKE '%nghìn%' OR x LIKE '%ngàn%' THEN coalesce({_num("list_last(string_split(x, 'triệu'))", '[0-9]+([.,][0-9]+)?', 'DECIMAL(15,2)')}, 0) * 1000 ELSE 0 END
          ELSE 7 END AS DOUBLE) AS price, count(*) AS n FROM ({_texts_sql(_PRICE_FORMS)}) GROUP BY ALL""",
    ),
    Query(
        "price_m2_if_plausible",
        lambda spark, d: _texts(spark, d, _AREA_FORMS).select("x", F.floor("l_extendedprice").cast("long").alias("p"), F.when(F.col("l_returnflag") == "A", "md").otherwise("m2").alias("u"))
        .groupBy("x", "u", rules.price_m2_if_plausible(F.col("p"), F.col("x"), F.col("u"), 20_000, 900).alias("v")).agg(F.count("*").alias("n")),
        f"""SELECT x, u, CASE WHEN u = 'm2' AND p >= 20000 AND a > 0 AND p / a >= 900 THEN CAST(trunc(p / a) AS BIGINT) ELSE p END AS v, count(*) AS n FROM (
          SELECT x, CASE WHEN l_returnflag = 'A' THEN 'md' ELSE 'm2' END AS u, CAST(floor(l_extendedprice) AS BIGINT) AS p, CASE WHEN regexp_full_match(x, '[0-9]+([.,][0-9]+)?') THEN CAST(replace(x, ',', '.') AS DOUBLE) END AS a
          FROM ({_texts_sql(_AREA_FORMS)})) GROUP BY ALL""",
    ),
    Query(
        "property_columns",
        lambda spark, d: table(spark, d, "lineitem").select(F.expr(_pick(_KINDS, "l_partkey")).alias("c"), F.expr(_pick(_TRADES, "l_orderkey")).alias("t"), F.expr(_pick(_PAPERS, "l_suppkey")).alias("p"))
        .withColumns(rules.property_columns(F.col("c"), F.col("t"), F.col("p"))).groupBy("c", "t", "p", "property_type", "type_id", "cat_id", "stratum_id").agg(F.count("*").alias("n")),
        f"""SELECT c, t, p, CASE WHEN t IN ('mua', 'bán') THEN CASE c {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.SALE_NAMES.items())} ELSE c END WHEN t = 'thuê' THEN CASE c {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.RENT_NAMES.items())} ELSE c END ELSE c END AS property_type,
        CASE WHEN t = 'thuê' THEN {_PHRASES('lower(c)', rules.RENT_TYPES, 2)} ELSE {_PHRASES('lower(c)', rules.SALE_TYPES, 2)} END AS type_id,
        CASE WHEN t = 'thuê' THEN 3 WHEN regexp_matches(lower(c), 'đất thổ cư|đất nền|nông nghiệp|lâm nghiệp') THEN 2 ELSE 1 END AS cat_id,
        {_PHRASES('lower(p)', rules.PAPERS, 'NULL')} AS stratum_id, count(*) AS n
        FROM (SELECT {_pick(_KINDS, 'l_partkey')} AS c, {_pick(_TRADES, 'l_orderkey')} AS t, {_pick(_PAPERS, 'l_suppkey')} AS p FROM lineitem) GROUP BY ALL""",
    ),
]

_TRADE = "CASE l_returnflag WHEN 'A' THEN 's' WHEN 'R' THEN 'u' ELSE 'x' END"
for _name, _g in rules.GROUPS.items():
    _c = "trim(regexp_replace(lower(replace(replace(strip_accents(c), 'đ', 'd'), 'Đ', 'D')), '[^a-z0-9]+', ' ', 'g'))" if _g.fold else "c"
    _groups = f"CASE WHEN {_c} IN {_in(_g.houses)} THEN 1 WHEN {_c} IN {_in(_g.flats)} THEN 2 WHEN {_c} IN {_in(_g.land)} THEN 3 END"
    if _g.others is not None:
        _groups = _groups.replace(" END", f" WHEN {_c} NOT IN {_in(_g.others)} THEN 4 END")
    _groups = _groups if _g.any_trade else f"CASE WHEN t = 's' THEN {_groups} END"
    QUERIES.append(Query(
        f"group_{_name}",
        lambda spark, d, g=_g: table(spark, d, "lineitem").select(F.expr(_pick(_categories(g), "l_partkey")).alias("c"), F.expr(_TRADE).alias("t"))
        .groupBy("c", "t", g.of(F.col("c"), F.col("t")).alias("grp")).agg(F.count("*").alias("n")),
        f"SELECT c, t, CASE WHEN t IN {_in(_g.rent)} THEN 4 ELSE {_groups} END AS grp, count(*) AS n FROM (SELECT {_pick(_categories(_g), 'l_partkey')} AS c, {_TRADE} AS t FROM lineitem) GROUP BY ALL",
    ))

for _name, _l in rules.LAND_PRICES.items():
    _cats = [*_l.shares, "khác"]
    _product = lambda s, cut: "CAST(p AS BIGINT)" if s == 1 else f"CAST({'trunc' if cut else 'round_even'}(p * CAST({s} AS DOUBLE){'' if cut else ', 0'}) AS BIGINT)"
    _value = "CASE " + " ".join(f"WHEN c = '{c}' THEN {_product(s, _l.cut)}" for c, s in _l.shares.items()) + " END"
    _value = f"CASE WHEN t = 's' AND p > 0 THEN {_value} END"
    QUERIES.append(Query(
        f"land_price_{_name}",
        lambda spark, d, r=_l, cats=_cats: table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_pick(cats, "l_partkey")).alias("c"), F.expr(_TRADE).alias("t"), F.floor("l_extendedprice").cast("double").alias("p"))
        .withColumn("r", r.of(F.col("c"), F.col("t"), F.col("p"))).select("l_orderkey", "l_linenumber", "l_partkey", "r.price_land", "r.status"),
        f"SELECT l_orderkey, l_linenumber, l_partkey, {_value} AS price_land, CASE WHEN {_value} IS NULL THEN 'SKIP' ELSE 'DONE' END AS status FROM (SELECT *, {_pick(_cats, 'l_partkey')} AS c, {_TRADE} AS t, CAST(floor(l_extendedprice) AS DOUBLE) AS p FROM lineitem)",
    ))

QUERIES += [
    Query(
        "price_m2_generic",
        lambda spark, d: table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rules.price_m2(F.floor("l_extendedprice").cast("long"), F.col("l_quantity") - 5, whole=True).alias("price_m2")),
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN floor(l_extendedprice) > 0 AND l_quantity - 5 > 0 THEN CAST(trunc(floor(l_extendedprice) / (l_quantity - 5)) AS BIGINT) END AS price_m2 FROM lineitem",
    ),
    Query(
        "price_m2_by_unit",
        lambda spark, d: table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            rules.price_m2_by_unit(F.floor("l_extendedprice") * 10000, F.col("l_quantity"), F.when(F.col("l_linestatus") == "O", "m2").when(F.col("l_returnflag") == "A", "md").otherwise("can")).alias("v"),
        ).withColumn("v", F.floor(F.col("v") * 100 + 0.5) / 100),
        f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {round_sql('''CASE WHEN l_linestatus = 'O' THEN CASE WHEN p < 500000000 THEN p ELSE p / l_quantity END WHEN l_returnflag = 'A' THEN p / l_quantity END''')} AS v
        FROM (SELECT *, floor(l_extendedprice) * 10000 AS p FROM lineitem WHERE TRUE)""",
    ),
    Query(
        "trade_kind_words",
        lambda spark, d: table(spark, d, "orders").select(F.expr(_pick(["s", "U", "mua", "Cần bán", "cho thuê", "thue", "ban gap", "khác"], "o_orderkey")).alias("x")).groupBy("x", rules.trade_kind(F.col("x")).alias("kind")).agg(F.count("*").alias("n")),
        f"""SELECT x, CASE WHEN lower(x) IN ('s', 'mua') THEN 's' WHEN lower(x) = 'u' THEN 'u' WHEN lower(x) LIKE '%ban%' OR lower(x) LIKE '%bán%' THEN 's' WHEN lower(x) LIKE '%thue%' OR lower(x) LIKE '%thuê%' THEN 'u' END AS kind, count(*) AS n
        FROM (SELECT {_pick(["s", "U", "mua", "Cần bán", "cho thuê", "thue", "ban gap", "khác"], "o_orderkey")} AS x FROM orders) GROUP BY ALL""",
    ),
    Query(
        "trade_kind_urls",
        lambda spark, d: table(spark, d, "pages").select("page_id", F.concat(F.regexp_replace("url", "/en/", "/ban-nha/"), F.when(F.col("page_id") % 3 == 0, "/cho-thue-can-ho").otherwise("")).alias("u"))
        .select("page_id", rules.trade_kind_of_url(F.col("u")).alias("kind"), rules.trade_kind_of_number(F.col("page_id") % 4).alias("number")),
        "SELECT page_id, CASE WHEN u LIKE '%/ban-%' THEN 's' WHEN u LIKE '%/cho-thue-%' THEN 'u' END AS kind, CASE WHEN page_id % 4 IN (1, 2) THEN 's' WHEN page_id % 4 = 3 THEN 'u' END AS number FROM (SELECT page_id, replace(url, '/en/', '/ban-nha/') || CASE WHEN page_id % 3 = 0 THEN '/cho-thue-can-ho' ELSE '' END AS u FROM pages)",
    ),
    Query(
        "fold_accents",
        lambda spark, d: table(spark, d, "documents").select("doc_id", F.md5(text.words_only(F.col("text"))).alias("folded"), F.md5(text.slug(F.col("text"))).alias("slug")),
        r"""SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g'))) AS folded,
        md5(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '-')) AS slug FROM documents""",
    ),
    Query(
        "project_names",
        lambda spark, d: table(spark, d, "part").select("p_partkey", F.concat(F.expr(_pick(["Khu đô thị mới ", "Chung cư căn hộ ", "Dự án ", "The "], "p_partkey")), F.col("p_name"), F.lit(" "), F.col("p_size")).alias("x"))
        .select("p_partkey", text.project_name(F.col("x")).alias("norm"), text.project_core(F.col("x")).alias("core"), text.trailing_number(text.project_name(F.col("x"))).alias("number")),
        f"""SELECT p_partkey, norm, trim(regexp_replace(norm, '^(?:(?:{"|".join(text.PROJECT_PREFIXES)})(?: |$))+', '')) AS core, nullif(regexp_extract(norm, '(\\d+)(?:\\s*[a-z])?$', 1), '') AS number FROM (
          SELECT p_partkey, trim(regexp_replace(regexp_replace(trim(regexp_replace(lower(replace(replace(strip_accents(x), 'đ', 'd'), 'Đ', 'D')), '[^a-z0-9]+', ' ', 'g')), '\\b(the|du an|khu do thi|kdt|kdc)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS norm
          FROM (SELECT p_partkey, {_pick(["Khu đô thị mới ", "Chung cư căn hộ ", "Dự án ", "The "], "p_partkey")} || p_name || ' ' || p_size AS x FROM part))""",
    ),
    Query(
        "place_names",
        lambda spark, d: table(spark, d, "customer").select("c_custkey", F.concat(F.expr(_pick(["Phường ", "P. ", "Xã ", "TT ", "p "], "c_custkey")), F.format_string("%02d", F.col("c_nationkey"))).alias("w"), F.concat(F.expr(_pick(["Tỉnh ", "TP. ", "Thành phố "], "c_custkey")), F.col("c_mktsegment")).alias("p"))
        .select("c_custkey", text.ward_name(F.col("w")).alias("ward"), text.province_name(F.col("p")).alias("province")),
        "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS ward, lower(c_mktsegment) AS province FROM customer",
    ),
    Query(
        "address_parts",
        lambda spark, d: table(spark, d, "customer").withColumn("a", F.expr("CASE c_custkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN c_name || ', ' || c_mktsegment WHEN 2 THEN '12 Main, ' || c_name || ', ' || c_mktsegment ELSE '12, Main, W1, ' || c_name || ', ' || c_mktsegment END"))
        .select("c_custkey", *[text.address_part(F.col("a"), i).alias(n) for i, n in ((1, "city"), (2, "district"), (3, "ward"))], text.street_part(F.col("a")).alias("street")),
        """SELECT c_custkey, c_mktsegment AS city, CASE WHEN c_custkey % 4 > 0 THEN c_name END AS district, CASE c_custkey % 4 WHEN 2 THEN '12 Main' WHEN 3 THEN 'W1' END AS ward, CASE c_custkey % 4 WHEN 3 THEN '12, Main' END AS street FROM customer""",
    ),
    Query(
        "normal_urls",
        lambda spark, d: table(spark, d, "pages").select("page_id", text.normal_url(F.concat(F.regexp_replace("url", "http", "HTTP"), F.when(F.col("url").contains("?"), "&a=1").otherwise("/"))).alias("url")),
        r"""SELECT page_id, regexp_extract(bare, '^[a-z]+://[^/]*', 0) || CASE WHEN rest = '' THEN '/' ELSE rest END
          || CASE WHEN q IS NULL THEN '' ELSE '?' || list_aggregate(list_sort(q), 'string_agg', '&') END AS url
        FROM (SELECT page_id, bare, rtrim(regexp_replace(split_part(bare, '?', 1), '^[a-z]+://[^/]*', ''), '/') AS rest, CASE WHEN contains(bare, '?') THEN string_split(split_part(bare, '?', 2), '&') END AS q
          FROM (SELECT page_id, regexp_replace(url || CASE WHEN contains(url, '?') THEN '&a=1' ELSE '/' END, '#.*$', '') AS bare FROM pages))""",
    ),
    Query(
        "url_ids",
        lambda spark, d: table(spark, d, "pages").select("page_id", F.nullif(F.regexp_extract("url", r"/(\d+)", 1), F.lit("")).alias("id"), F.md5(F.substring_index("url", "?", 1)).alias("base"), F.substring_index(F.substring_index("url", "/", 3), "/", -1).alias("host")),
        r"SELECT page_id, nullif(regexp_extract(url, '/(\d+)', 1), '') AS id, md5(split_part(url, '?', 1)) AS base, split_part(url, '/', 3) AS host FROM pages",
    ),
    Query(
        "phones",
        lambda spark, d: table(spark, d, "customer").select("c_custkey", F.concat(F.lit("Tel: +84 "), F.format_string("%09d", F.col("c_custkey")), F.when(F.col("c_custkey") % 5 == 0, " ***").otherwise("")).alias("x")).select("c_custkey", text.phone(F.col("x")).alias("phone")),
        "SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN '+84' || printf('%09d', c_custkey) END AS phone FROM customer",
    ),
    Query(
        "degrees_decimal",
        lambda spark, d: table(spark, d, "customer").select("c_custkey", F.format_string("%d° %d' %d\" %s", F.col("c_custkey") % 90, F.col("c_custkey") % 60, F.col("c_nationkey"), F.when(F.col("c_custkey") % 2 == 0, "N").otherwise("W")).alias("x"))
        .select("c_custkey", (F.floor(text.degrees(F.col("x")) * 1e6 + 0.5) / 1e6).alias("v")),
        "SELECT c_custkey, floor(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END * (CAST(c_custkey % 90 AS DOUBLE) + CAST(c_custkey % 60 AS DOUBLE) / 60 + CAST(c_nationkey AS DOUBLE) / 3600) * 1000000.0::DOUBLE + 0.5) / 1000000.0 AS v FROM customer",
    ),
    Query(
        "markup_removed",
        lambda spark, d: table(spark, d, "pages").select("page_id", F.md5(text.without_markup(F.col("html"))).alias("plain")),
        r"SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '!\[[^\]]*\]\([^)]*\)', '', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS plain FROM pages",
    ),
    Query(
        "dates_compact_and_epoch",  # thirty years on, so that milliseconds have thirteen digits
        lambda spark, d: table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").cast("long").alias("c"), ((F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + 946080000) * F.when(F.col("o_orderkey") % 2 == 0, 1000).otherwise(1)).alias("e"))
        .select("o_orderkey", parse.compact_date(F.col("c")).alias("compact"), F.date_format(parse.epoch_by_size(F.col("e")), "yyyy-MM-dd").alias("by_size"), F.date_format(parse.epoch_by_length(F.col("e")), "yyyy-MM-dd").alias("by_length")),
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS compact, strftime(o_orderdate + to_seconds(946080000), '%Y-%m-%d') AS by_size, strftime(o_orderdate + to_seconds(946080000), '%Y-%m-%d') AS by_length FROM orders",
    ),
    Query(
        "dates_any_form",
        lambda spark, d: table(spark, d, "orders").select("o_orderkey", F.expr("CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy') WHEN 2 THEN date_format(o_orderdate, 'dd-MM-yyyy') WHEN 3 THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") ELSE '31/02/2024' END").alias("x"))
        .select("o_orderkey", F.date_format(parse.any_date(F.col("x")), "yyyy-MM-dd").alias("day")),
        "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    ),
    Query(
        "dates_relative",
        lambda spark, d: table(spark, d, "events").select("event_id", "ts", F.concat((F.col("event_id") % 14 + 1).cast("string"), F.expr(_pick([" phút trước", " giờ trước", " ngày trước", " tuần trước", " tháng trước", "hôm nay"], "event_id"))).alias("x"))
        .select("event_id", F.date_format(parse.posted_before(F.col("x"), F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("at")),
        """SELECT event_id, strftime(CASE event_id % 6 WHEN 0 THEN ts - to_minutes(n) WHEN 1 THEN ts - to_hours(n) WHEN 2 THEN ts - to_days(CAST(n AS INTEGER)) WHEN 3 THEN ts - to_days(CAST(7 * n AS INTEGER))
          WHEN 4 THEN date_trunc('month', ts) - to_months(CAST(n AS INTEGER)) + to_days(CAST(least(day(ts), 28) - 1 AS INTEGER)) + (ts - date_trunc('day', ts)) ELSE ts END, '%Y-%m-%d %H:%M:%S') AS at
        FROM (SELECT event_id, ts, event_id % 14 + 1 AS n FROM events)""",
    ),
    Query(
        "period_keys",
        lambda spark, d: table(spark, d, "orders").select("o_orderkey", parse.month_key(F.col("o_orderdate")).alias("month")).withColumns({
            "quarter": parse.quarter_key(F.col("month")), "before": parse.shifted_month(F.col("month"), -1), "year_before": parse.shifted_month(F.col("month"), -12),
        }),
        """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS before,
        strftime(date_trunc('month', o_orderdate) - INTERVAL 12 MONTH, '%Y-%m') AS year_before FROM orders""",
    ),
    Query(
        "last_sundays",
        lambda spark, d: table(spark, d, "orders").select("o_orderkey", parse.last_sunday(F.to_date("o_orderdate")).alias("sunday"), parse.last_sunday(F.to_date("o_orderdate"), before=True).alias("sunday_before")),
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS sunday, CAST(o_orderdate AS DATE) - CAST(CASE WHEN dayofweek(o_orderdate) = 0 THEN 7 ELSE dayofweek(o_orderdate) END AS INTEGER) AS sunday_before FROM orders",
    ),
    Query(
        "json_landed",
        lambda spark, d: landed(table(spark, d, "events").select("event_id", "props"), "props", _schema("k int, other string")),
        "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS other FROM events",
    ),
    Query(
        "snake_names",
        lambda spark, d: table(spark, d, "supplier").select("s_suppkey", snake_case(F.concat(F.lit("supplierName"), F.col("s_suppkey"), F.lit("URLPart"))).alias("name")),
        "SELECT s_suppkey, 'supplier_name' || s_suppkey || '_url_part' AS name FROM supplier",
    ),
    Query(
        "page_fields",
        lambda spark, d: extract.extracted(table(spark, d, "pages").select("page_id", "html"), [
            extract.Field("title", "article h1"), extract.Field("lang", "html[lang]", "lang"), extract.Field("first_link", "nav li a", "href"), extract.Field("ad", "//div[@class='ad']", exclude=("Nicht",)),
        ]).select("page_id", F.md5("title").alias("title"), "lang", "first_link", F.md5("ad").alias("ad")),
        rf"""SELECT page_id, md5(nullif(trim(regexp_replace({_decoded(r"regexp_extract(html, '(?is)<article[^>]*>\s*<h1[^>]*>(.*?)</h1>', 1)")}, '\s+', ' ', 'g')), '')) AS title,
        nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang, nullif(regexp_extract(html, '<li><a href="([^"]*)"', 1), '') AS first_link,
        md5(nullif(trim(replace(trim(regexp_replace({_decoded(r'''regexp_extract(html, '(?is)<div class=["'']?ad["'']?>(.*?)</div>', 1)''')}, '\s+', ' ', 'g')), 'Nicht', '')), '')) AS ad FROM pages""",
    ),
    Query(
        "page_patterns",
        lambda spark, d: table(spark, d, "pages").select("page_id", *[F.size(c).cast("long").alias(n) for n, c in extract.by_patterns(F.col("html"), {"links": r'href="([^"]+)"', "paragraphs": "<p>"}).items()]),
        """SELECT page_id, CAST(len(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS BIGINT) AS links, CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS paragraphs FROM pages""",
    ),
]


def _schema(ddl: str):
    from pyspark.sql import types as T

    return T.StructType.fromDDL(ddl)
