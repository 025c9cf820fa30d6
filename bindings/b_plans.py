"""C1 (J1, M1, M2), C4 (A16-A18), C5 (A11-A15), A22-A24, J25, M21."""

from pyspark.sql import functions as F

from bindings.base import AS_OF_EVENTS, AS_OF_ORDERS, query
from crosswalk.operators import checks as K
from crosswalk.operators import filters as L
from crosswalk.operators import match as M
from crosswalk.operators import reconcile as R
from crosswalk.operators import usage as U
from crosswalk.operators import windows as W
from crosswalk.functions import columns as C
from crosswalk.plans import funnel, hygiene, master, medallion

# ---- C1 ---------------------------------------------------------------------------------------------------------



def rules():
    warn = {"valid_customer": F.col("c_custkey").isNotNull(), "valid_price": F.col("o_totalprice") > 1000}
    drop = {"has_line": F.col("l_linenumber").isNotNull(), "known_brand": F.col("p_brand") != "Brand#13"}
    return warn, drop


COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "c_custkey", "c_name", "n_name", "l_linenumber", "l_shipdate", "p_name", "p_brand", "s_name"]
NAMES = {
    "o_orderkey": "submission_id", "o_orderstatus": "submission_status", "o_orderdate": "submitted_at", "c_custkey": "property_id", "c_name": "property_name",
    "n_name": "company_name", "l_linenumber": "document_no", "l_shipdate": "document_at", "p_name": "document_name", "s_name": "document_source",
}
STAR = """
star AS (SELECT o.*, l.l_linenumber, l.l_shipdate, c.c_custkey, c.c_name, n.n_name, p.p_name, p.p_brand, s.s_name FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey),
clean AS (SELECT * FROM star WHERE NOT COALESCE(upper(p_name) LIKE '%BLUE R%' OR upper(n_name) LIKE '%_17%' OR n_name IN ('NATION_3'), FALSE) AND l_linenumber IS NOT NULL AND p_brand <> 'Brand#13'),
dim AS (SELECT DISTINCT o_orderkey AS submission_id, o_orderstatus AS submission_status, o_orderdate AS submitted_at, c_custkey AS property_id, c_name AS property_name, n_name AS company_name,
  l_linenumber AS document_no, l_shipdate AS document_at, p_name AS document_name, s_name AS document_source FROM clean WHERE o_orderkey IS NULL OR o_orderdate IS NOT NULL)
"""


def bronze(i):
    edges = [
        R.Edge(i.lineitem, ["o_orderkey"], ["l_orderkey"]), R.Edge(i.customer, ["o_custkey"], ["c_custkey"]), R.Edge(i.nation, ["c_nationkey"], ["n_nationkey"]),
        R.Edge(i.part, ["l_partkey"], ["p_partkey"]), R.Edge(i.supplier, ["l_suppkey"], ["s_suppkey"]),
    ]
    return medallion.bronze(i.orders, edges, COLUMNS)


def gold(i):
    excluded = L.exclusion_condition(["p_name"], ["%BLUE R%"]) | L.exclusion_condition(["n_name"], ["%_17%"], ids={"n_name": ["NATION_3"]})
    rows = medallion.silver(bronze(i), excluded, rules()[1])
    return medallion.gold(rows, NAMES, {"valid_times": F.col("o_orderkey").isNull() | F.col("o_orderdate").isNotNull()})


@query("c1_dimension", f"WITH {STAR} SELECT * FROM dim")
def c1(i):
    return gold(i)


@query("m1_expect", """
SELECT id, sync_key, balance FROM entity WHERE sync_key IS NOT NULL AND balance > 100 AND COALESCE(updated_at >= inserted_at, FALSE)
""")
def m1(i):
    drop = {"has_key": F.col("sync_key").isNotNull(), "positive": F.col("balance") > 100, "times": F.col("updated_at") >= F.col("inserted_at")}
    return K.expect(i.entity, drop).select("id", "sync_key", "balance")


@query("m1_expectation_counts", f"""
WITH {STAR} SELECT 'valid_customer' AS rule, 'warn' AS action, count(*) FILTER (WHERE c_custkey IS NOT NULL) AS passed, count(*) FILTER (WHERE c_custkey IS NULL) AS failed FROM star
UNION ALL SELECT 'valid_price', 'warn', count(*) FILTER (WHERE o_totalprice > 1000), count(*) FILTER (WHERE NOT COALESCE(o_totalprice > 1000, FALSE)) FROM star
UNION ALL SELECT 'has_line', 'drop', count(*) FILTER (WHERE l_linenumber IS NOT NULL), count(*) FILTER (WHERE l_linenumber IS NULL) FROM star
UNION ALL SELECT 'known_brand', 'drop', count(*) FILTER (WHERE p_brand <> 'Brand#13'), count(*) FILTER (WHERE NOT COALESCE(p_brand <> 'Brand#13', FALSE)) FROM star
""")
def m1_counts(i):
    return medallion.quality_report(bronze(i), *rules())


@query("m2_dimension_summary", f"""
WITH {STAR} SELECT count(*) AS total_rows, count(DISTINCT company_name) AS companies, count(DISTINCT property_id) AS properties, count(DISTINCT submission_id) AS submissions,
  min(submitted_at) AS earliest, max(submitted_at) AS latest FROM dim
""")
def m2(i):
    return K.table_summary(gold(i), {"companies": "company_name", "properties": "property_id", "submissions": "submission_id"}, "submitted_at")


# ---- C4 ---------------------------------------------------------------------------------------------------------

BASE = r"regexp_replace(regexp_replace(lower(name), '\bphase\s*([0-9]+|[ivx]+)\b', ''), '[^a-z0-9]', '', 'g')"
LEDGER = f"""
act AS (SELECT * FROM item WHERE status = 'ACTIVE'),
ph AS (SELECT id, brand || '/' || {BASE} AS base, CASE regexp_extract(lower(name), '\\bphase\\s*([0-9]+|[ivx]+)\\b', 1) WHEN 'ii' THEN 2 ELSE TRY_CAST(regexp_extract(lower(name), '\\bphase\\s*([0-9]+|[ivx]+)\\b', 1) AS INT) END AS number
  FROM act WHERE lower(name) LIKE '%phase%'),
led AS (SELECT id, 'Test' AS reason FROM act WHERE lower(name) LIKE '%test%' OR lower(name) LIKE '%demo%'
  UNION SELECT p.id, 'Phased Out' FROM ph p WHERE p.number < (SELECT max(q.number) FROM ph q WHERE q.base = p.base)
  UNION SELECT l_partkey, 'Partner' FROM lineitem JOIN act ON act.id = l_partkey WHERE l_quantity > 49)
"""


def active(i):
    return i.item.filter("status = 'ACTIVE'")


def parts(i):
    rows = active(i)
    tests = L.keyword_flag(rows, "id", "name", [("contains", "test", ""), ("contains", "demo", "")])
    members = rows.filter(F.lower("name").contains("phase")).select(
        "id", "status", F.concat_ws("/", "brand", C.series_base(F.col("name"))).alias("base"), C.series_number(F.col("name")).alias("number")
    )
    old = W.series_to_drop(W.series_status(members, "base", "number", F.lit(True)), "id")
    partner = i.lineitem.filter("l_quantity > 49").select(F.col("l_partkey").alias("id")).distinct().join(rows, "id", "left_semi")
    return {"Test": tests, "Phased Out": old, "Partner": partner}


def ledger(i):
    return hygiene.exclusion_ledger(parts(i), "id")


@query("a16_exclusion_ledger", f"WITH {LEDGER} SELECT * FROM led")
def a16(i):
    return ledger(i)


@query("a16_survivors", f"WITH {LEDGER} SELECT id, name FROM act WHERE id NOT IN (SELECT id FROM led)")
def a16_survivors(i):
    return hygiene.survivors(active(i), ledger(i), "id").select("id", "name")


@query("a16_ledger_counts", f"WITH {LEDGER} SELECT reason, count(*) AS excluded FROM led GROUP BY reason")
def a16_counts(i):
    return hygiene.ledger_counts(ledger(i))


@query("a17_exclusion_waterfall", f"""
WITH {LEDGER}, b AS (SELECT count(DISTINCT id) e, count(DISTINCT brand) p, CAST(sum(size) AS BIGINT) u FROM act), a AS (SELECT count(DISTINCT id) e, count(DISTINCT brand) p, CAST(sum(size) AS BIGINT) u FROM act WHERE id NOT IN (SELECT id FROM led))
SELECT 'Before Filtering' AS step, e AS entities, p AS parents, u AS units, 1 AS sort_order FROM b UNION ALL SELECT 'After Filtering', e, p, u, 2 FROM a
UNION ALL SELECT 'Delta (Excluded)', b.e - a.e, b.p - a.p, b.u - a.u, 3 FROM a, b
""")
def a17(i):
    return hygiene.exclusion_waterfall(active(i), ledger(i), "id", "brand", "size")


@query("a17_excluded_by_rule", """
SELECT CASE WHEN lower(name) LIKE '%test%' OR lower(name) LIKE '%demo%' THEN 'Test/Demo' WHEN regexp_matches(lower(name), 'phase\\s*[0-9]') THEN 'Phased' ELSE 'Tiny' END AS reason, count(*) AS excluded,
  CAST(sum(size) AS BIGINT) AS excluded_units, CASE WHEN lower(name) LIKE '%test%' OR lower(name) LIKE '%demo%' THEN 1 WHEN regexp_matches(lower(name), 'phase\\s*[0-9]') THEN 2 ELSE 3 END AS sort_order
FROM item WHERE status = 'ACTIVE' AND (lower(name) LIKE '%test%' OR lower(name) LIKE '%demo%' OR regexp_matches(lower(name), 'phase\\s*[0-9]') OR size < 3) GROUP BY 1, 4
""")
def a17_rules(i):
    text = F.lower("name")
    found = [(text.contains("test") | text.contains("demo"), "Test/Demo"), (text.rlike(r"phase\s*[0-9]"), "Phased"), (F.col("size") < 3, "Tiny")]
    return hygiene.excluded_by_rule(active(i), found, "size", ["Test/Demo", "Phased", "Tiny"])


@query("a18_net_active_count", f"WITH {LEDGER} SELECT count(DISTINCT id) AS entities, count(DISTINCT brand) AS parents, CAST(sum(size) AS BIGINT) AS units FROM act WHERE id NOT IN (SELECT id FROM led)")
def a18(i):
    return hygiene.net_active_count(active(i), "id", "brand", "size", list(parts(i).values()))


# ---- C5 ---------------------------------------------------------------------------------------------------------

CHANNELS = {"bank": "BANK_LINKING", "payroll": "CONNECTED_PAYROLL", "document": "DOCUMENT_UPLOAD"}
USAGE = """
us AS (SELECT applicant_id, CAST(bool_or(source_type = 'BANK_LINKING') AS INT) AS used_bank, CAST(bool_or(source_type = 'CONNECTED_PAYROLL') AS INT) AS used_payroll, CAST(bool_or(source_type = 'DOCUMENT_UPLOAD') AS INT) AS used_document,
  count(DISTINCT submission_id) AS total_submissions, count(DISTINCT submission_id) FILTER (WHERE source_type = 'BANK_LINKING') AS bank_submissions,
  min(created_at) FILTER (WHERE source_type = 'BANK_LINKING') AS first_bank_at, max(created_at) FILTER (WHERE source_type = 'BANK_LINKING') AS last_bank_at FROM submission GROUP BY applicant_id)
"""


OUTCOMES = """
outcomes AS (SELECT applicant_id, count(DISTINCT check_id) AS income_count, count(DISTINCT check_id) AS asset_count,
  CAST(bool_or(income_status = 'ACCEPTED') AS INT) AS income_accepted, CAST(bool_or(income_status = 'REJECTED') AS INT) AS income_rejected, max(income_status) AS income_status,
  COALESCE(string_agg(DISTINCT income_reason, ', ' ORDER BY income_reason), '') AS income_reasons,
  CAST(bool_or(asset_status = 'ACCEPTED') AS INT) AS asset_accepted, CAST(bool_or(asset_status = 'REJECTED') AS INT) AS asset_rejected, max(asset_status) AS asset_status,
  COALESCE(string_agg(DISTINCT asset_reason, ', ' ORDER BY asset_reason), '') AS asset_reasons
  FROM submission WHERE source_type = 'BANK_LINKING' GROUP BY applicant_id)
"""


REPORT = USAGE + "," + OUTCOMES + f""",
eligible AS (SELECT a.* FROM applicant a JOIN (SELECT entity_id, min(changed_at) AS enabled_at FROM feature_log WHERE code = '1-URGENT' AND state = 'enabled' GROUP BY entity_id) f
  ON f.entity_id = a.entity_id AND a.submitted_at >= f.enabled_at WHERE a.created_at >= TIMESTAMP '1996-01-01 00:00:00'),
identity_counts AS (SELECT applicant_id, count(DISTINCT check_id) AS id_count FROM identity_check GROUP BY applicant_id),
facts AS (SELECT e.applicant_id, e.entity_id, e.place_id, e.submitted_at, COALESCE(used_bank, 0) AS used_bank, COALESCE(used_payroll, 0) AS used_payroll, COALESCE(used_document, 0) AS used_document,
  COALESCE(total_submissions, 0) AS total_submissions, COALESCE(bank_submissions, 0) AS bank_submissions, first_bank_at, COALESCE(id_count, 0) AS id_count, COALESCE(income_count, 0) AS income_count,
  COALESCE(asset_count, 0) AS asset_count, income_reasons, asset_reasons, COALESCE(used_bank = 1, FALSE) AS used, id_count IS NOT NULL AS identified, income_count IS NOT NULL AS decided,
  COALESCE(income_accepted = 1, FALSE) AS income_good, COALESCE(asset_accepted = 1, FALSE) AS asset_good, COALESCE(income_rejected = 1, FALSE) AS income_bad, COALESCE(asset_rejected = 1, FALSE) AS asset_bad,
  (epoch_us(last_bank_at) - epoch_us(first_bank_at)) // 60000000 AS duration_minutes, (epoch_us(TIMESTAMP '{AS_OF_ORDERS}') - epoch_us(e.submitted_at)) // 3600000000 AS hours_since_submission
  FROM eligible e LEFT JOIN us USING (applicant_id) LEFT JOIN identity_counts USING (applicant_id) LEFT JOIN outcomes USING (applicant_id)),
rep AS (SELECT *, income_good OR asset_good AS good, income_bad OR asset_bad AS bad,
  CASE WHEN used AND identified THEN 'both' WHEN used THEN 'bank only' WHEN identified THEN 'identity only' ELSE 'none' END AS pairing,
  CASE WHEN income_good THEN 'yes' ELSE 'no' END AS income_result, CASE WHEN asset_good THEN 'yes' ELSE 'no' END AS asset_result,
  CASE WHEN income_good OR asset_good THEN 'yes' WHEN income_bad OR asset_bad THEN 'no' WHEN decided THEN 'open' ELSE 'undecided' END AS recommendation,
  CASE WHEN used AND identified AND decided THEN 'whole' WHEN used AND identified THEN 'unfinished' WHEN used THEN 'unidentified' ELSE 'elsewhere' END AS usage,
  CASE WHEN used AND NOT identified THEN 'identity missing' WHEN used AND NOT decided THEN 'result missing' WHEN bank_submissions > 3 THEN 'many tries' WHEN duration_minutes > 60 THEN 'took long' END AS issue,
  CASE WHEN hours_since_submission > 48 THEN 'late' ELSE 'in time' END AS timeliness FROM facts)
"""
WORDS_REPORT = funnel.Words(
    paired="both", channel_only="bank only", identity_only="identity only", neither="none", complete="whole", no_identity="unidentified", no_result="unfinished", other_way="elsewhere",
    accepted="yes", rejected="no", waiting="open", undecided="undecided", nothing="nothing", late="late", on_time="in time", no_reason="?",
)
KINDS = {p: (f"{p}_status", f"{p}_reason") for p in ("income", "asset")}
SHOWN = [
    "applicant_id", "entity_id", "submitted_at", "used_bank", "used_payroll", "used_document", "total_submissions", "bank_submissions", "first_bank_at", "duration_minutes", "id_count", "pairing",
    "income_count", "income_result", "income_reasons", "asset_count", "asset_result", "asset_reasons", "recommendation", "usage", "issue", "hours_since_submission", "timeliness",
]


def usage(i):
    return funnel.usage_flags(i.submission, "applicant_id", "submission_id", "source_type", "created_at", CHANNELS, "bank")


def outcomes(i, kinds=KINDS):
    return funnel.verification_outcomes(i.submission, "applicant_id", "check_id", kinds, "ACCEPTED", "REJECTED", F.col("source_type") == "BANK_LINKING")


def report(i):
    features = i.feature_log.filter("code = '1-URGENT' AND state = 'enabled'").select("entity_id", "changed_at")
    base = funnel.eligible_applicants(i.applicant, features, "entity_id", "submitted_at", "changed_at", "1996-01-01 00:00:00", "created_at")
    ids = i.identity_check.groupBy("applicant_id").agg(
        F.count_distinct("check_id").alias("id_count"), F.max((F.col("status") == "SUCCESS").cast("int")).alias("id_passed")
    )
    known = funnel.facts("bank")
    issues = [
        (known.used & ~known.identified, "identity missing"), (known.used & ~known.decided, "result missing"),
        (F.col("bank_submissions") > 3, "many tries"), (F.col("duration_minutes") > 60, "took long"),
    ]
    base = base.drop("created_at", "enabled_at")
    return funnel.applicant_report(base, [usage(i), ids, outcomes(i)], "applicant_id", "submitted_at", "bank", AS_OF_ORDERS, issues, 48, WORDS_REPORT)


@query("a11_usage_flags", f"WITH {USAGE} SELECT * FROM us")
def a11(i):
    return usage(i)


@query("a12_verification_outcomes", f"WITH {OUTCOMES} SELECT applicant_id, income_count, income_accepted, income_rejected, income_status, income_reasons FROM outcomes")
def a12(i):
    return outcomes(i, {"income": KINDS["income"]})


@query("a12_outcome_reasons", """
WITH r AS (SELECT 'income' AS kind, income_reason AS reason, applicant_id FROM submission WHERE source_type = 'BANK_LINKING' UNION ALL SELECT 'asset', asset_reason, applicant_id FROM submission WHERE source_type = 'BANK_LINKING')
SELECT kind, reason, count(*) AS rejections, count(DISTINCT applicant_id) AS applicants FROM r WHERE reason IS NOT NULL GROUP BY kind, reason
""")
def a12_reasons(i):
    return funnel.outcome_reasons(i.submission, "applicant_id", KINDS, F.col("source_type") == "BANK_LINKING")


@query("a13_applicant_report", f"WITH {REPORT} SELECT {', '.join(SHOWN)} FROM rep")
def a13(i):
    return report(i).select(*SHOWN)


@query("a13_ruling_reason", f"""
WITH {REPORT}, w AS (SELECT *, used OR used_payroll = 1 OR used_document = 1 AS sent FROM rep)
SELECT applicant_id, CASE WHEN good THEN 'yes' WHEN bad THEN 'no' WHEN sent THEN 'open' ELSE 'nothing' END AS ruling,
  CASE WHEN income_good THEN 'income yes' WHEN asset_good THEN 'assets yes' WHEN income_bad THEN 'income no: ' || COALESCE(NULLIF(income_reasons, ''), '?')
  WHEN asset_bad THEN 'assets no: ' || COALESCE(NULLIF(asset_reasons, ''), '?') WHEN sent THEN 'open' ELSE 'nothing' END AS reason FROM w
""")
def a13_ruling(i):
    return funnel.ruling_reason(report(i), list(CHANNELS), {"income": "income", "asset": "assets"}, WORDS_REPORT).select("applicant_id", "ruling", "reason")


KPI = {"total": "Total Applicants", "channel": "Bank Linking Adoption", "identity": "ID Verification Adoption", "paired": "Bank Linking + ID Verification", "passed": "Passed Recommendations",
       "failed": "Failed Recommendations", "issues": "Applicants with Issues"}
KPI_BASE = {"channel": "total", "identity": "total", "paired": "channel", "passed": "channel", "failed": "channel", "issues": "total"}
KPI_ROWS = "\n UNION ALL ".join(
    f"SELECT '{KPI[k]}', {k}, printf('%.2f%%', round(100.0::DOUBLE * {k} / {b}, 2)), 'Share of {b}' FROM one" for k, b in KPI_BASE.items()
)


@query("a14_kpi_table", f"""
WITH {REPORT}, one AS (SELECT count(*) AS total, count(*) FILTER (WHERE used) AS channel, count(*) FILTER (WHERE identified) AS identity, count(*) FILTER (WHERE used AND identified) AS paired,
  count(*) FILTER (WHERE good) AS passed, count(*) FILTER (WHERE bad) AS failed, count(issue) AS issues FROM rep)
SELECT 'Total Applicants' AS metric, total AS count, '100%' AS percentage, NULL AS notes FROM one UNION ALL {KPI_ROWS}
""")
def a14(i):
    return funnel.kpi_table(report(i), "bank", KPI)


@query("a15_issue_breakdown", f"""
WITH {REPORT} SELECT issue, count(*) AS applicants, count(DISTINCT place_id) AS places, min(submitted_at) AS first_at, max(submitted_at) AS last_at FROM rep WHERE issue IS NOT NULL GROUP BY issue
""")
def a15(i):
    return funnel.issue_breakdown(report(i), "applicant_id", "place_id", "submitted_at")


@query("a15_issue_places", f"WITH {REPORT} SELECT issue, place_id, count(*) AS applicants FROM rep WHERE issue IS NOT NULL GROUP BY 1, 2")
def a15_places(i):
    return funnel.issue_places(report(i), "place_id")


@query("a15_place_performance", f"""
WITH {REPORT}, n AS (SELECT place_id, count(*) AS total_applicants, count(*) FILTER (WHERE used) AS channel_users, count(*) FILTER (WHERE used AND identified) AS paired, count(*) FILTER (WHERE good) AS passed, count(issue) AS issues FROM rep GROUP BY place_id)
SELECT place_id, total_applicants, channel_users, round(100.0::DOUBLE * channel_users / total_applicants, 2) AS adoption_pct, round(100.0::DOUBLE * paired / NULLIF(channel_users, 0), 2) AS id_correlation_pct,
  round(100.0::DOUBLE * passed / NULLIF(channel_users, 0), 2) AS success_pct, issues FROM n
""")
def a15_performance(i):
    return funnel.place_performance(report(i), "place_id", "bank")


# ---- managers and master rows -----------------------------------------------------------------------------------

PROPS = """
prop AS (SELECT id, name, parent_id AS company_id, status, inserted_at, updated_at, units, CASE WHEN balance < 500 THEN NULL WHEN balance > 6000 THEN ' ' || upper(segment) ELSE lower(segment) || ' ' || CAST(parent_id AS STRING) END AS manager_name FROM entity),
part_co AS (SELECT DISTINCT CAST(s_nationkey AS INT) AS company_id FROM supplier WHERE s_acctbal > 9000),
mgr AS (SELECT name_key, min(trim(manager_name)) AS name, min(inserted_at) AS created_at, max(updated_at) AS updated_at, count(*) FILTER (WHERE status = 'ACTIVE') > 0 AS is_active, count(DISTINCT id) AS property_count, count(DISTINCT company_id) AS company_count,
  sha256(name_key) AS manager_id, CASE WHEN bool_or(company_id IN (SELECT company_id FROM part_co)) THEN 'Partner' ELSE 'Direct' END AS channel
  FROM (SELECT *, trim(lower(manager_name)) AS name_key FROM prop) WHERE name_key <> '' GROUP BY name_key)
"""


def properties(i):
    manager = F.when(F.col("balance") < 500, None).when(F.col("balance") > 6000, F.concat(F.lit(" "), F.upper("segment"))).otherwise(
        F.concat(F.lower("segment"), F.lit(" "), F.col("parent_id").cast("string"))
    )
    return i.entity.select("id", "name", F.col("parent_id").alias("company_id"), "status", "inserted_at", "updated_at", "units", manager.alias("manager_name"))


def partners(i):
    return i.supplier.filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("company_id"))


def managers(i):
    return master.manager_master(properties(i), "manager_name", "id", "company_id", "status", "inserted_at", "updated_at", partners(i))


@query("a22_manager_master", f"WITH {PROPS} SELECT * FROM mgr")
def a22(i):
    return managers(i)


MASTER = PROPS + """,
newest_account AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY modified DESC, account_id) AS rn FROM (
    SELECT s_suppkey AS account_id, 'nation_' || CAST(s_nationkey AS STRING) AS name_key, s_acctbal AS modified, s_suppkey + 40 AS csm_id, s_suppkey + 7 AS seller_id, 'a' || CAST(s_suppkey AS STRING) || '@x' AS mail,
      CASE WHEN s_acctbal > 8000 THEN 'Large' END AS segment FROM supplier)) WHERE rn = 1),
account AS (SELECT n.*, c.s_name AS csm, s.s_name AS seller FROM newest_account n LEFT JOIN supplier c ON c.s_suppkey = n.csm_id LEFT JOIN supplier s ON s.s_suppkey = n.seller_id),
config AS (SELECT n_nationkey AS config_id, r_name AS kind FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey <> 2 AND n_name NOT LIKE '%_3'),
integration AS (SELECT * FROM (SELECT o_custkey AS id, o_orderdate AS activated_at, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, 'x' || CAST(o_orderkey AS STRING)) AS rn FROM orders WHERE o_totalprice > 450000) WHERE rn = 1),
outbound AS (SELECT i.*, c.kind FROM integration i LEFT JOIN config c ON c.config_id = i.o_orderkey % 25),
feature AS (SELECT entity_id AS id, min(changed_at) AS feature_enabled_at FROM feature_log WHERE code = '2-HIGH' AND state = 'enabled' GROUP BY entity_id),
check_start AS (SELECT entity_id AS id, min(inserted_at) AS first_check_at FROM checks GROUP BY entity_id),
area AS (SELECT o_custkey AS id, min('county ' || CAST(o_orderkey % 9 AS STRING)) AS county FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
known AS (SELECT p.*, c.name AS company_name, m.manager_id, m.name AS manager, m.channel AS manager_channel, pc.company_id IS NOT NULL AS partnered, o.activated_at, o.kind, o.o_orderkey, f.feature_enabled_at, k.first_check_at, r.county,
    a.csm, a.segment, a.account_id, a.seller, a.mail, b.csm AS manager_csm
  FROM prop p JOIN parent c ON c.id = p.company_id LEFT JOIN mgr m ON m.name_key = trim(lower(p.manager_name)) LEFT JOIN part_co pc ON pc.company_id = p.company_id LEFT JOIN outbound o ON o.id = p.id
  LEFT JOIN feature f ON f.id = p.id LEFT JOIN check_start k ON k.id = p.id LEFT JOIN area r ON r.id = p.id LEFT JOIN account a ON a.name_key = trim(lower(c.name)) LEFT JOIN account b ON b.name_key = m.name_key),
mast AS (SELECT id, company_id, status, units, company_name, manager_id, manager AS manager_name, manager_channel, COALESCE(manager, company_name) AS display_name, if(partnered, 'Partner', 'Direct') AS company_channel,
  if(partnered OR activated_at IS NOT NULL, 'yes', 'no') AS uses_integration, COALESCE(activated_at, if(partnered, inserted_at, NULL)) AS integration_enabled_at, kind AS outbound_kind, if(partnered, company_name, NULL) AS inbound_kind,
  if(activated_at IS NULL, NULL, 'x' || CAST(o_orderkey AS STRING)) AS external_id, feature_enabled_at IS NOT NULL AS feature_enabled, if(status = 'DISABLED', updated_at, NULL) AS deactivated_at,
  COALESCE(first_check_at, if(feature_enabled_at IS NULL, NULL, map {'ACTIVE': updated_at, 'DISABLED': inserted_at}[status])) AS check_enabled_at, county AS area_county,
  COALESCE(csm, if(partnered, 'partner ' || company_name, 'open')) AS company_owner, COALESCE(segment, if(account_id IS NULL, 'unknown', 'no tier')) AS company_tier, seller AS company_seller, mail AS company_mail, manager_csm FROM known)
"""
MASTER_COLUMNS = ["id", "company_id", "company_name", "manager_id", "manager_name", "manager_channel", "display_name", "company_channel", "uses_integration", "integration_enabled_at", "external_id", "feature_enabled",
                  "deactivated_at", "check_enabled_at", "company_owner", "company_tier", "outbound_kind", "inbound_kind", "area_county", "company_seller", "company_mail", "manager_csm"]


def property_master(i):
    accounts = i.supplier.select(
        F.col("s_suppkey").alias("account_id"), F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("name"), F.col("s_acctbal").alias("modified"),
        (F.col("s_suppkey") + 40).alias("csm_id"), (F.col("s_suppkey") + 7).alias("seller_id"), F.concat(F.lit("a"), F.col("s_suppkey").cast("string"), F.lit("@x")).alias("mail"),
        F.when(F.col("s_acctbal") > 8000, "Large").alias("segment"),
    )
    accounts = M.account_lookup(accounts, i.supplier, "account_id", "name", "modified", {"csm": "csm_id", "seller": "seller_id"}, "s_suppkey", "s_name", ["segment", "mail"])
    integrations = i.orders.filter("o_totalprice > 450000").select(
        F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("activated_at"), (F.col("o_orderkey") % 25).alias("config_id"),
        F.to_json(F.struct(F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("k"))).alias("details"),
    )
    in_use = i.nation.filter("n_regionkey <> 2 AND n_name NOT LIKE '%_3'").join(i.region, F.col("r_regionkey") == F.col("n_regionkey"))
    configurations = in_use.select(F.col("n_nationkey").alias("config_id"), F.col("n_name").alias("name"), F.col("r_name").alias("kind"))
    features = i.feature_log.filter("code = '2-HIGH' AND state = 'enabled'").select(F.col("entity_id").alias("id"), F.col("changed_at").alias("enabled_at"))
    checks = i.checks.select(F.col("entity_id").alias("id"), "inserted_at")
    areas = i.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"), F.concat(F.lit("county "), (F.col("o_orderkey") % 9).cast("string")).alias("county"))
    return master.property_master(
        properties(i).drop("name").withColumnRenamed("manager_name", "manager_raw"), i.parent, managers(i), integrations, features, checks, partners(i), accounts, "id", "company_id", "manager_raw",
        areas, configurations, ["account_id", "csm", "segment", "seller", "mail"], ["$.propertyId", "$.k"], master.MasterWords("partner ", "open", "no tier", "unknown"),
    )


@query("j25_property_master", f"WITH {MASTER} SELECT {', '.join(MASTER_COLUMNS)} FROM mast")
def j25(i):
    return property_master(i).select(*MASTER_COLUMNS)


@query("a23_manager_rollup", f"""
WITH {MASTER} SELECT manager_name, manager_channel, count(DISTINCT id) AS property_count, count(DISTINCT company_id) AS company_count, count(*) FILTER (WHERE status = 'ACTIVE') AS active_properties,
  count(*) FILTER (WHERE feature_enabled) AS with_feature, CAST(sum(units) AS BIGINT) AS total_units FROM mast WHERE manager_name IS NOT NULL GROUP BY 1, 2
""")
def a23(i):
    return master.manager_rollup(property_master(i), ["manager_name", "manager_channel"], "id", "company_id", "units")


PATTERN = r"(?:from|join|into|update|table)\s+[`\"]?app\.(\w+\.\w+)[`\"]?"


@query("a24_reference_usage", """
WITH x AS (SELECT DISTINCT id, executed_by, start_time, kind, unnest(regexp_extract_all(lower(statement_text), '(?:from|join|into|update|table)\\s+[`"]?app\\.(\\w+\\.\\w+)[`"]?', 1)) AS name FROM statement)
SELECT name, count(*) AS total_uses, count(DISTINCT executed_by) AS unique_users, count(*) FILTER (WHERE kind = 'SELECT') AS read_uses, count(*) FILTER (WHERE kind IN ('INSERT', 'UPDATE')) AS write_uses, min(start_time) AS first_use,
  max(start_time) AS last_use, round(count(*)::DOUBLE / 30, 2) AS uses_per_day, round(100.0::DOUBLE * count(*) FILTER (WHERE kind = 'SELECT') / count(*), 1) AS read_pct, CAST(date_diff('day', CAST(max(start_time) AS DATE), DATE '2024-01-31') AS INT) AS days_idle
FROM x GROUP BY name
""")
def a24(i):
    rows = U.references(i.statement, "statement_text", PATTERN)
    return U.reference_usage(rows, "name", "executed_by", "start_time", F.col("kind") == "SELECT", F.col("kind").isin("INSERT", "UPDATE"), 30, AS_OF_EVENTS)


@query("a24_page_links", r"""
WITH x AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(lower(html), 'href="/([a-z]+)"', 1)) AS link FROM pages) SELECT link, count(*) AS pages FROM x GROUP BY link
""")
def a24_links(i):
    rows = U.references(i.pages, "html", r'href="/([a-z]+)"', "link")
    return rows.groupBy("link").agg(F.count(F.lit(1)).alias("pages"))


WORDS = {"status": ["status", "flag"], "segment": ["segment", "priority"]}


def top_sql(feature, table, column):
    return f"SELECT * FROM (SELECT '{feature}' AS feature, '{table}' AS table_name, '{column}' AS column_name, CAST({column} AS STRING) AS value, count(*) AS row_count FROM {table} GROUP BY {column} ORDER BY row_count DESC, value LIMIT 5)"


@query("m21_column_keyword_search", " UNION ALL ".join(top_sql(*t) for t in [
    ("status", "orders", "o_orderstatus"), ("status", "lineitem", "l_returnflag"), ("status", "lineitem", "l_linestatus"), ("segment", "customer", "c_mktsegment"), ("segment", "orders", "o_orderpriority"),
]))
def m21(i):
    tables = {"orders": i.orders, "lineitem": i.lineitem, "customer": i.customer, "part": i.part}
    return U.top_values(tables, U.column_keyword_search(tables, WORDS), 5)
