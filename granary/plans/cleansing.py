"""Scans, typing, standardisation and document facts on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import banking, standard, typing
from .registry import Registry

_r = Registry()
QUERIES, ORACLES, add = _r.queries, _r.oracles, _r.add


@add("SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'")
def scan_slice(t):
    return t("events").where("ts >= TIMESTAMP_NTZ '2024-01-05 00:00:00' AND ts < TIMESTAMP_NTZ '2024-01-06 00:00:00'").select("event_id", "user_id", "event_type", "value")


@add("SELECT event_type, COUNT(*) AS events, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total, CAST(MAX(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_most FROM events GROUP BY event_type")
def json_props(t):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return t("events").groupBy("event_type").agg(F.count("*").alias("events"), F.sum(k).alias("k_total"), F.max(k).alias("k_most"))


@add("""SELECT ccy AS currency, COUNT(*) AS orders, CAST(SUM(CAST(round(price * rate, 2) AS DECIMAL(18,2))) AS DOUBLE) AS home_amount
    FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'INR' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'XYZ' END AS ccy, o_totalprice AS price FROM orders) o
    LEFT JOIN (VALUES ('INR', 1.0::DOUBLE), ('USD', 83.25::DOUBLE), ('EUR', 90.5::DOUBLE)) r(c, rate) ON r.c = o.ccy GROUP BY ccy""")
def config_join(t):
    orders = t("orders").select(F.element_at(F.array(*map(F.lit, ("INR", "USD", "EUR", "XYZ"))), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("currency"), F.col("o_totalprice").alias("price"))
    rates = orders.sparkSession.createDataFrame([("INR", 1.0), ("USD", 83.25), ("EUR", 90.5)], "currency string, rate double")
    return banking.to_home_currency(orders, rates, "price", "currency", "home").groupBy("currency").agg(F.count("*").alias("orders"), F.sum("home").cast("double").alias("home_amount"))


@add("""SELECT k, CAST(CASE WHEN regexp_matches(v, '^[+-]?[0-9]+([.][0-9]*)?$') THEN regexp_extract(v, '^([+-]?[0-9]+)', 1) END AS BIGINT) AS as_whole,
        CAST(TRY_CAST(v AS DECIMAL(18,2)) AS DOUBLE) AS as_decimal, TRY_CAST(try_strptime(d, '%Y-%m-%d') AS DATE) AS as_date
    FROM (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN '1.7' WHEN 2 THEN 'abc' WHEN 3 THEN '-12.50' END AS v,
            CASE o_orderkey % 3 WHEN 0 THEN '1985-02-30' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'n/a' END AS d FROM orders) x""")
def typed_columns(t):
    key = F.col("o_orderkey")
    v = F.when(key % 5 == 0, key.cast("string")).when(key % 5 == 1, "1.7").when(key % 5 == 2, " abc ").when(key % 5 == 3, "-12.50").otherwise("  ")
    d = F.when(key % 3 == 0, "1985-02-30").when(key % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/a")
    return t("orders").select(key.alias("k"), typing.typed(v, "bigint").alias("as_whole"), typing.typed(v, "decimal").cast("double").alias("as_decimal"), typing.typed(d, "date").alias("as_date"))


@add("""SELECT c_custkey, NULLIF(trim(regexp_replace(regexp_replace(s, '^(MR|MRS|MS|MISS|DR|SHRI|SMT|PROF) ', ''), '\\b(MOHD|MOHAMMAD)\\b', 'MOHAMMED', 'g')), '') AS name_std
    FROM (SELECT c_custkey, trim(regexp_replace(regexp_replace(upper(CASE c_custkey % 4 WHEN 0 THEN 'Mr. ' WHEN 1 THEN 'mrs ' WHEN 2 THEN 'Mohd ' ELSE '' END || c_mktsegment || '  o''Neil-' || c_name), '[^A-Z ]', ' ', 'g'), '\\s+', ' ', 'g')) AS s FROM customer) x""")
def std_name(t):
    raw = F.concat(F.when(F.col("c_custkey") % 4 == 0, "Mr. ").when(F.col("c_custkey") % 4 == 1, "mrs ").when(F.col("c_custkey") % 4 == 2, "Mohd ").otherwise(""), "c_mktsegment", F.lit("  o'Neil-"), "c_name")
    return t("customer").select("c_custkey", standard.name(raw).alias("name_std"))


@add("SELECT p_partkey, array_to_string(list_sort(string_split(trim(regexp_replace(regexp_replace(upper(p_name || ' ' || p_type), '[^A-Z ]', ' ', 'g'), '\\s+', ' ', 'g')), ' ')), ' ') AS name_key FROM part")
def name_key(t):
    return t("part").select("p_partkey", standard.name_key(standard.name(F.concat_ws(" ", "p_name", "p_type"))).alias("name_key"))


@add("""SELECT c_custkey, CASE WHEN regexp_matches(ten, '^[6-9][0-9]{9}$') THEN '+91' || ten END AS mobile
    FROM (SELECT c_custkey, CASE WHEN length(d) = 12 AND starts_with(d, '91') THEN substr(d, 3) WHEN length(d) = 11 AND starts_with(d, '0') THEN substr(d, 2) ELSE d END AS ten
        FROM (SELECT c_custkey, regexp_replace(CASE c_custkey % 4 WHEN 0 THEN '+91 9' WHEN 1 THEN '08' WHEN 2 THEN '5' ELSE '7-' END || lpad(CAST(c_custkey AS VARCHAR), 9, '0'), '[^0-9]', '', 'g') AS d FROM customer) x) y""")
def std_mobile(t):
    raw = F.concat(F.when(F.col("c_custkey") % 4 == 0, "+91 9").when(F.col("c_custkey") % 4 == 1, "08").when(F.col("c_custkey") % 4 == 2, "5").otherwise("7-"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    return t("customer").select("c_custkey", standard.mobile(raw).alias("mobile"))


@add("""SELECT s_suppkey, CASE WHEN regexp_matches(p, '^[A-Z]{5}[0-9]{4}[A-Z]$') THEN p END AS pan FROM (SELECT s_suppkey, upper(trim(CASE s_suppkey % 3 WHEN 0 THEN ' abcde' WHEN 1 THEN 'ABCD' ELSE 'AbCdE' END || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') || 'f ')) AS p FROM supplier) x""")
def std_pan(t):
    raw = F.concat(F.when(F.col("s_suppkey") % 3 == 0, " abcde").when(F.col("s_suppkey") % 3 == 1, "ABCD").otherwise("AbCdE"), F.lpad((F.col("s_suppkey") % 10000).cast("string"), 4, "0"), F.lit("f "))
    return t("supplier").select("s_suppkey", standard.pan(raw).alias("pan"))


@add(r"""SELECT doc_id, email FROM (SELECT doc_id, lower(regexp_extract(text, '([A-Za-z0-9._]+@[A-Za-z0-9.]+[.][A-Za-z]{2,})', 1)) AS email FROM documents) x WHERE regexp_matches(email, '^[^@\s]+@[^@\s]+\.[a-z]{2,}$')""")
def std_email_extract(t):
    raw = F.regexp_extract("text", "([A-Za-z0-9._]+@[A-Za-z0-9.]+[.][A-Za-z]{2,})", 1)
    return t("documents").select("doc_id", standard.email(raw).alias("email")).where("email IS NOT NULL")


@add(r"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(CAST(c_custkey AS VARCHAR) || ', MG. Rd., nr. St. Park  Ngr'), '\bRD\b\.?', 'ROAD', 'g'), '\bST\b\.?', 'STREET', 'g'), '\bNGR\b\.?', 'NAGAR', 'g'), '\bMG\.', 'MG', 'g'), '\bNR\b\.?', 'NEAR', 'g'), '[^A-Z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS address_std,
        NULLIF(regexp_extract(CAST(560000 + c_custkey AS VARCHAR), '([0-9]{6})', 1), '') AS pincode FROM customer""")
def std_address(t):
    raw = F.concat(F.col("c_custkey").cast("string"), F.lit(", MG. Rd., nr. St. Park  Ngr"))
    return t("customer").select("c_custkey", standard.address(raw).alias("address_std"), standard.pincode((F.col("c_custkey") + 560000).cast("string")).alias("pincode"))


@add("""SELECT a.n_name AS name_a, b.n_name AS name_b, round(1 - levenshtein(a.n_name, b.n_name) / greatest(length(a.n_name), length(b.n_name)), 4) AS similarity FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey""")
def name_similarity(t):
    a, b = t("nation").alias("a"), t("nation").alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_name").alias("name_a"), F.col("b.n_name").alias("name_b"), standard.similarity(F.col("a.n_name"), F.col("b.n_name")).alias("similarity"))


@add(r"""SELECT doc_id, NULLIF(trim(regexp_extract(text, '([A-Za-z0-9._]+@[A-Za-z0-9.]+[.][A-Za-z]{2,})', 1)), '') AS email, NULLIF(trim(regexp_extract(text, '([0-9]{3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3})', 1)), '') AS address, NULLIF(regexp_extract(text, '(\([0-9]{3}\) [0-9]{3}-[0-9]{4})', 1), '') AS phone FROM documents""")
def doc_entities(t):
    found = {"email": "([A-Za-z0-9._]+@[A-Za-z0-9.]+[.][A-Za-z]{2,})", "address": "([0-9]{3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3})", "phone": r"(\([0-9]{3}\) [0-9]{3}-[0-9]{4})"}
    return t("documents").select("doc_id", *[F.nullif(F.trim(F.regexp_extract("text", p, 1)), F.lit("")).alias(c) for c, p in found.items()])


#: Subject lines that documents get, by doc_id: one without, one that is blank text, and some for each intent.
_MAILS = {0: "Change of ADDRESS", 1: "a Complaint about an address", 2: "complaint", 3: "Complaints", 4: "address complaint", 5: "monthly statement"}


@add(f"""WITH mails(k, subject) AS (VALUES {', '.join(f"({k}, '{v}')" for k, v in _MAILS.items())}), m AS (
        SELECT doc_id, CASE WHEN doc_id % 9 = 8 THEN '  ' WHEN subject IS NULL THEN text WHEN doc_id % 18 = 5 THEN text || chr(10) || 'Subject: ' || subject || ' (KYC)' ELSE text || chr(10) || 'Subject: ' || subject END AS body FROM documents LEFT JOIN mails ON k = doc_id % 9
    ) SELECT doc_id, CASE WHEN regexp_full_match(coalesce(body, ''), ' *') THEN 'UNREADABLE' WHEN body ILIKE '%kyc%' THEN 'KYC_DECLARATION' WHEN regexp_extract(body, '(?m)^Subject:[ \\t]*(.+)$', 1) ILIKE '%address%' THEN 'ADDRESS_CHANGE' WHEN regexp_extract(body, '(?m)^Subject:[ \\t]*(.+)$', 1) ILIKE '%complaint%' THEN 'COMPLAINT' ELSE 'OTHER' END AS intent FROM m""")
def doc_intent(t):
    """The intent of each document, its subject taken out of the whole text, wherever the line stands."""
    k = F.col("doc_id") % 9
    line = F.concat(F.lit("\nSubject: "), F.coalesce(*[F.when(k == i, v) for i, v in _MAILS.items()]), F.when(F.col("doc_id") % 18 == 5, " (KYC)").otherwise(""))
    body = F.when(k == 8, "  ").when(k.isin(*_MAILS), F.concat("text", line)).otherwise(F.col("text"))
    facts = banking.document_facts(t("documents").select("doc_id", body.alias("text")))
    return facts.select("doc_id", banking.document_intent(F.lit("text/plain"), F.col("text"), F.col("subject")).alias("intent"))


@add("SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, regexp_extract(url, '^[a-z]+://([^/?]+)', 1) AS host FROM pages")
def html_title(t):
    return t("pages").select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"), F.regexp_extract("url", "^[a-z]+://([^/?]+)", 1).alias("host"))


@add("SELECT event_id, round(CASE WHEN event_type IN ('purchase', 'click') THEN value ELSE 0 END, 4) AS fee, round(CASE WHEN event_type IN ('purchase', 'view') THEN value * 0.18 ELSE 0 END, 4) AS gst, CASE WHEN event_type IN ('purchase', 'click') THEN CAST(event_id AS VARCHAR) END AS fee_id FROM events")
def json_array_hof(t):
    item = lambda kind, amount: F.concat(F.lit(f'{{"type":"{kind}","value":"'), F.col("event_id").cast("string"), F.lit('","amount":'), amount.cast("string"), F.lit("}"))
    fee, gst = item("FEE", F.col("value")), item("GST", F.col("value") * 0.18)
    has_fee, has_gst = F.col("event_type").isin("purchase", "click"), F.col("event_type").isin("purchase", "view")
    text = F.concat(F.lit("["), F.concat_ws(",", F.when(has_fee, fee), F.when(has_gst, gst)), F.lit("]"))
    items = F.from_json(text, "array<struct<type:string,value:string,amount:double>>")
    return t("events").select("event_id", items.alias("i")).select("event_id", F.round(banking.json_sum_by_type(F.col("i"), "FEE"), 4).alias("fee"), F.round(banking.json_sum_by_type(F.col("i"), "GST"), 4).alias("gst"), banking.json_value_by_type(F.col("i"), "FEE").alias("fee_id"))


@add("""SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'LOSS' WHEN dpd <= 90 THEN 'STANDARD' WHEN dpd - 90 <= 365 THEN 'SUBSTANDARD' WHEN dpd - 90 <= 730 THEN 'DOUBTFUL_1' WHEN dpd - 90 <= 1460 THEN 'DOUBTFUL_2' ELSE 'DOUBTFUL_3' END AS asset_class,
        CASE WHEN dpd <= 0 THEN 'REGULAR' WHEN dpd <= 30 THEN 'SMA-0' WHEN dpd <= 60 THEN 'SMA-1' WHEN dpd <= 90 THEN 'SMA-2' ELSE 'NPA' END AS sma FROM (SELECT o_orderkey, CAST(o_orderkey * 7 % 2000 - 50 AS BIGINT) AS dpd FROM orders) x""")
def asset_class_bands(t):
    dpd = F.col("o_orderkey") * 7 % 2000 - 50
    return t("orders").select("o_orderkey", banking.asset_class(dpd, F.col("o_orderkey") % 97 == 0).alias("asset_class"), banking.sma_status(dpd).alias("sma"))


@add("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS calendar_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, CAST(d AS DATE) = last_day(d) AS is_month_end,
        'FY' || CAST(year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END AS VARCHAR) || '-' || lpad(CAST((year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END + 1) % 100 AS VARCHAR), 2, '0') AS fiscal_year, CAST(((month(d) + 8) % 12) // 3 + 1 AS INTEGER) AS fiscal_quarter
    FROM (SELECT unnest(generate_series(TIMESTAMP '2015-01-01', TIMESTAMP '2027-12-31', INTERVAL 1 DAY)) AS d) x""")
def calendar_dim(t):
    return banking.calendar(t("region").sparkSession, "2015-01-01", "2027-12-31")


@add("SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS instant FROM events WHERE event_id % 10 <> 0 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 10 = 0")
def source_instants(t):
    """Wall clocks of the source's zone as instants; what isn't a time is NULL."""
    text = F.when(F.col("event_id") % 10 == 0, "2024-13-45 10:00:00").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t("events").select("event_id", F.date_format(typing.source_instant(text), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@add("""SELECT c_custkey, 'CUSTOMER ' || c_mktsegment AS name_std, array_to_string(list_sort(['CUSTOMER', c_mktsegment]), ' ') AS name_key, '+919' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mobile_e164,
    CASE WHEN c_custkey % 3 = 0 THEN 'ABCDE' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || 'Z' END AS pan_std, CASE WHEN c_custkey % 4 <> 0 THEN 'c' || CAST(c_custkey AS VARCHAR) || '@mail.example.com' END AS email_std,
    CAST(c_nationkey AS VARCHAR) || ' MG ROAD ' || CAST(400000 + c_nationkey AS VARCHAR) AS address_std, CAST(400000 + c_nationkey AS VARCHAR) AS pincode_std FROM customer""")
def person_std(t):
    """All standard forms of a person's record at once."""
    key, place = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    rows = t("customer").select(
        "c_custkey",
        F.concat(F.lit("Mr. Customer "), F.lower("c_mktsegment")).alias("full_name"),
        F.concat(F.lit("0"), F.lit("9"), F.lpad(key, 9, "0")).alias("mobile"),
        F.concat(F.when(F.col("c_custkey") % 3 == 0, "abcde").otherwise("12"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"), F.lit("z ")).alias("pan"),
        F.concat(F.lit("C"), key, F.when(F.col("c_custkey") % 4 == 0, " at ").otherwise("@"), F.lit("Mail.example.com")).alias("email"),
        F.concat(place.cast("string"), F.lit(", MG Rd. - "), (place + 400000).cast("string")).alias("address"),
    )
    return standard.person(rows).select("c_custkey", "name_std", "name_key", "mobile_e164", "pan_std", "email_std", "address_std", "pincode_std")


@add("""SELECT o_orderkey, CASE o_orderkey % 2 WHEN 0 THEN d ELSE c END AS own_account, CASE o_orderkey % 2 WHEN 0 THEN c ELSE d END AS counterparty_account, CASE o_orderkey % 2 WHEN 0 THEN cb ELSE db END AS counterparty_bank,
    CASE o_orderkey % 2 WHEN 0 THEN cb ELSE db END = 'NORB' AS is_on_us, CASE WHEN CASE o_orderkey % 2 WHEN 0 THEN db ELSE cb END = 'NORB' THEN 'ACC:CBS:' || CASE o_orderkey % 2 WHEN 0 THEN d ELSE c END END AS account_key
    FROM (SELECT o_orderkey, 'D' || CAST(o_custkey AS VARCHAR) AS d, 'C' || CAST(o_orderkey AS VARCHAR) AS c, CASE WHEN o_orderkey % 3 = 0 THEN 'HDFC' ELSE 'NORB' END AS db, CASE WHEN o_orderkey % 5 = 0 THEN 'NORB' ELSE 'ICIC' END AS cb FROM orders) x""")
def payment_sides(t):
    """Debtor and creditor turned into own and counterparty."""
    key = F.col("o_orderkey")
    rows = t("orders").select(
        "o_orderkey",
        F.when(key % 2 == 0, "DR").otherwise("CR").alias("direction"),
        F.concat(F.lit("D"), F.col("o_custkey").cast("string")).alias("debtor_account"),
        F.concat(F.lit("C"), key.cast("string")).alias("creditor_account"),
        F.when(key % 3 == 0, "HDFC0000009").otherwise("NORB0000001").alias("debtor_ifsc"),
        F.when(key % 5 == 0, "NORB0000001").otherwise("ICIC0000002").alias("creditor_ifsc"),
        F.lit("D").alias("debtor_name"),
        F.lit("C").alias("creditor_name"),
    )
    return banking.own_side(rows, "NORB").select("o_orderkey", "own_account", "counterparty_account", "counterparty_bank", "is_on_us", "account_key")


_SCAN_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE CAST(o_orderkey % 5000 AS INTEGER) END AS width, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE CAST(o_custkey AS INTEGER) END AS height FROM orders"


def _scans(t):
    """Beginnings of images; every tenth ends within its sizes."""
    word = lambda c: F.lpad(F.hex(c), 8, "0")
    whole = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), word(F.col("o_orderkey") % 5000), word(F.col("o_custkey")), F.lit("08")))
    rows = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, F.substring(whole, 1, 20)).otherwise(whole).alias("content"))
    width, height = banking.png_size(F.col("content"))
    return rows.withColumns({"width": width, "height": height})


@add(_SCAN_SQL)
def image_sizes(t):
    return _scans(t).select("o_orderkey", "width", "height")


@add(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'EMPTY' WHEN o_orderkey % 3 = 0 THEN CASE WHEN width = 0 THEN 'BAD_IMAGE' ELSE 'OK' END WHEN o_orderkey % 4 = 0 THEN 'OK' ELSE 'NO_IDENTIFIER' END AS extraction_status FROM ({_SCAN_SQL}) s""")
def extraction_statuses(t):
    key = F.col("o_orderkey")
    mime, size, pan = F.when(key % 3 == 0, "image/png").otherwise("text/plain"), F.when(key % 7 == 0, 0).otherwise(24), F.when(key % 4 == 0, F.lit("ABCDE1234F"))
    return _scans(t).select("o_orderkey", banking.extraction_status(size, mime, F.col("width"), [F.lit(None).cast("string"), pan]).alias("extraction_status"))
