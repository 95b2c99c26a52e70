"""A nested profile pool derived from the flat tables, and the same pool as SQL.

One record per customer key, and all rows of the tables take part. Forty orders with consecutive
keys are the roles of four records, which get 1, 7, 12 and 20 of them; keys are unique, so a record
holds at most 20 roles whatever the data look like. A skill sums up the lines of an order whose
numbers agree modulo four, so a record holds at most 80 skills. Orders and lines are dealt to their
record once, as keys and numbers, and joined there. Texts come from ``documents``, activity from ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schema
from ..functions.dates import months_cal
from ..session import materialize, partitions_for

SIZES = ["1-10", "11-50", "51-200", "201-500", "501-1000", "1001-5000", "5001-10000", "10001+", "n/a"]
TITLES = [
    "Junior Software Engineer", "Senior ML Engineer", "Staff Data Scientist", "Engineering Manager",
    "Marketing Manager", "Research Scientist", "Software Engineer", "Principal Architect",
    "Sales Executive", "HR generalist", "AI Engineer", "Business Analyst",
]
COMPANIES = [
    "TCS", "Acme Search", "Infosys Ltd", "Globex", "Tech Mahindra", "Initech", "Umbrella Labs",
    "Cognizant", "Hooli",
]
INDUSTRIES = [
    "Software", "IT Services", "Retail", "Fintech", "Consulting", "Academia", "Logistics", "Internet",
]
CITIES = [
    "Pune, Maharashtra", "Noida", "Hyderabad", "Mumbai", "Bangalore", "Chennai", "New Delhi",
    "Jaipur", "Berlin", "Lima",
]
DESCRIPTIONS = [
    "Built dense retrieval with sentence-transformers and FAISS; tuned NDCG and MRR offline.",
    "Maintained payroll spreadsheets and vendor contracts.",
    "Shipped RAG search to production traffic at scale with vector database indexes.",
    "The company was founded in 2021. Ran the marketplace recommendation system.",
    "LangChain and ChatGPT prototypes for an internal LLM helper.",
    "Machine learning classifier for search ranking; code review and CI/CD.",
    "Computer vision and object detection on lidar data; robotics research.",
    "Since its founding in 2016 the team deployed Kubernetes model serving with Triton.",
    "Led recruiting for sales teams, two-sided marketplace and talent sourcing.",
    "LoRA and QLoRA fine-tuning of language models, PEFT adapters.",
    "Established in 2019, the lab published a paper on named entity NER and NLP.",
    "Learning to rank with LambdaMART and XGBoost for ranking; A/B test analysis.",
    "Open source maintainer of a GitHub project; blog post and tech talk.",
    "Text classification and topic modeling for information retrieval.",
    "Latency and SLO work, inference optimization, vLLM on multi-GPU hosts.",
    "Academic lab postdoc, Ph.D. thesis on speech recognition.",
]
SKILLS = [
    "Python", "FAISS", "RAG", "NLP", "Excel", "Kubernetes", "LoRA", "Embeddings", "Pinecone",
    "Semantic Search", "SQL", "OpenCV", "NDCG", "LangChain", "XGBoost Ranking", "Docker",
    "Elasticsearch", "Marketing", "Neural Ranker", "QLoRA", "Weaviate", "Machine Learning",
    "Learning to Rank", "Java",
]
PROFICIENCIES = ["beginner", "intermediate", "advanced", "expert", "Expert"]
DEGREES = ["B.Tech", "M.Tech", "Ph.D.", "MBA", "B.Sc"]
FIELDS = [
    "Computer Science", "Mechanical", "Data Science", "History", "Statistics", "Marketing",
    "Electronics and Communication",
]
TIERS = ["tier_1", "tier_2", "tier_3", "tier_4", "unknown", "n/a"]
MODES = ["remote", "hybrid", "onsite", "flexible", "other"]
CERTS = ["AWS Solutions Architect", "Scrum Master", "Vector Search Basics", "Azure Fundamentals", "Cooking"]
ISSUERS = ["Amazon", "Agile Board", "Coursera", "Microsoft"]
# Assessment name per event type.
ASSESSMENTS = {
    "view": "RAG evaluation", "click": "NDCG", "purchase": "Python", "error": "FAISS", "signup": "Docker",
}

# Roles of the four records that share forty orders, as the first order of each.
FIRST_SLOTS = [0, 1, 8, 20]

_POOLS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


def _struct(dtype, **fields: Column) -> Column:
    return F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in dtype.fields])


def _place(key: str) -> tuple[Column, Column]:
    """(record, slot inside the record) of an order key."""
    at = F.col(key) % 40
    number, first = F.lit(0), F.lit(0)
    for i, start in enumerate(FIRST_SLOTS):
        number, first = F.when(at >= start, i).otherwise(number), F.when(at >= start, start).otherwise(first)
    return F.expr(f"{key} div 40") * 4 + number, at - first


def _roles(orders: DataFrame, parts: int) -> DataFrame:
    """The roles of a record. Only keys and dates move; the texts of a role are made where its record is."""
    o = F.col("o_orderkey")
    record, slot = _place("o_orderkey")
    # The record follows from the order's key, so it is made again where the order has moved to.
    moved = orders.filter(o.isNotNull()).select(F.col("o_orderdate").cast("date").alias("day"), o).repartition(parts, record)
    orders = moved.select(record.alias("record"), o, "day")
    record = F.col("record")
    limit = F.lit("2024-02-15").cast("date")
    current = (slot == 0) | ((slot == 1) & (record % 17 == 0))
    start = F.add_months("day", 264)
    stop = F.when(current, limit).otherwise(F.least(F.add_months(start, (1 + (o * 7) % 30).cast("int")), limit))
    dated = orders.select(
        record, slot.alias("slot"), o, current.alias("current"),
        start.alias("start"), stop.alias("stop"),
    )
    months = months_cal(F.col("start"), F.col("stop")) + F.when(o % 19 == 0, 6).otherwise(0)
    end = (
        F.when(F.col("current") & (o % 71 != 0), F.lit(None).cast("date"))
        .when(o % 97 == 0, F.add_months("stop", -40)).otherwise(F.col("stop"))
    )
    role = _struct(
        schema.ROLE,
        company=_pick(o, COMPANIES), title=_pick(F.floor(o / 3), TITLES),
        start_date=F.when(o % 41 == 0, "2024-02-30").when(o % 43 != 0, F.col("start").cast("string")),
        end_date=end.cast("string"),
        duration_months=F.when(o % 23 != 0, months), is_current=F.col("current"),
        industry=_pick(F.floor(o / 7), INDUSTRIES), company_size=_pick(F.floor(o / 11), SIZES),
        description=_pick(F.floor(o / 5), DESCRIPTIONS),
    )
    return dated.groupBy("record").agg(F.sort_array(F.collect_list(F.struct("slot", role.alias("role")))).alias("x")).select(
        "record", F.col("x.role").alias("career_history")
    )


def _skills(lineitem: DataFrame, parts: int) -> DataFrame:
    """The skills of a record. The lines move once, to their record; a skill is summed up and its texts are made there."""
    record = _place("l_orderkey")[0]
    # Like an order, a line moves without its record; the narrower columns stand side by side, which compresses better.
    moved = lineitem.filter(F.col("l_orderkey").isNotNull()).select(
        "l_quantity", "l_suppkey", (F.col("l_linenumber") % 4).alias("slot"), "l_partkey", "l_orderkey").repartition(parts, record)
    lines = moved.withColumn("record", record).groupBy("record", "l_orderkey", "slot").agg(
        F.min("l_partkey").alias("part"), F.max("l_suppkey").alias("supp"), F.max("l_quantity").alias("quantity"),
        F.count("*").alias("lines"))
    part, supp = F.col("part"), F.col("supp")
    months = F.when(part % 89 == 0, (F.col("quantity") - 1) * 20).otherwise(F.col("quantity") - 1)
    skill = _struct(
        schema.SKILL, name=_pick(part, SKILLS), proficiency=_pick(F.floor(part / 5), PROFICIENCIES),
        duration_months=F.when(supp % 41 != 0, months), endorsements=supp % 60 + F.col("lines"),
    )
    return (
        lines.groupBy("record")
        .agg(F.sort_array(F.collect_list(F.struct("l_orderkey", "slot", skill.alias("skill")))).alias("x"))
        .select("record", F.col("x.skill").alias("skills"))
    )


def _mean_cents(value: Column) -> Column:
    """The mean in whole cents, by integer division, so that it does not depend on the order of a sum."""
    cents = F.round(value * 100).cast("bigint")
    return F.floor(F.try_divide(F.sum(cents), F.count(value))) / F.lit(100.0)


def _activity(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("user_id").alias("record")).agg(
        F.count("*").alias("n_events"), F.max("ts").alias("last_ts"),
        _mean_cents(F.col("value")).alias("avg_value"),
        *[_mean_cents(F.when(F.col("event_type") == t, F.col("value"))).alias(f"avg_{t}") for t in ASSESSMENTS],
    )


def build_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested pool, one row per customer. All tables are dealt to the same parts, so that no join moves rows again."""
    k = F.col("c_custkey")
    parts = partitions_for(*[table(spark, sf_dir, t) for t in ("orders", "lineitem", "documents")], target_bytes=32 << 20)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").repartition(parts, "c_custkey")
    documents = table(spark, sf_dir, "documents").filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("record"), "text")
    joined = (
        customers.withColumn("record", k)
        .join(_roles(table(spark, sf_dir, "orders"), parts), "record", "left")
        .join(_skills(table(spark, sf_dir, "lineitem"), parts), "record", "left")
        .join(_activity(table(spark, sf_dir, "events")).repartition(parts, "record"), "record", "left")
        .join(documents.repartition(parts, "record"), "record", "left")
    )
    empty = F.lit(None)
    profile = _struct(
        schema.PROFILE,
        headline=F.when(k % 13 == 0, "").otherwise(F.concat(_pick(k, TITLES), F.lit(" | "), F.col("c_mktsegment"))),
        summary=F.when(k % 11 == 0, "Short bio").otherwise(F.coalesce("text", F.concat(F.lit("Works on "), _pick(F.floor(k / 3), DESCRIPTIONS)))),
        location=F.when(k % 47 != 0, _pick(k, CITIES)),
        country=F.when(k % 10 < 8, "India").otherwise("Elsewhere"),
        years_of_experience=F.when(k % 53 != 0, 1 + (k % 150) / F.lit(10.0)),
        current_title=_pick(k, TITLES), current_company=_pick(k, COMPANIES),
        current_company_size=_pick(k, SIZES), current_industry=_pick(k, INDUSTRIES),
    )

    def education(i: int) -> Column:
        start = 2000 + (k + i) % 15
        return _struct(
            schema.EDUCATION, degree=_pick(k + i, DEGREES), field_of_study=_pick(k + i, FIELDS),
            institution=F.concat(F.lit("University "), (k % 30).cast("string")), start_year=start,
            end_year=F.when(k % 61 == 0, start - 1).otherwise(start + 4), tier=_pick(k + i, TIERS),
        )

    def certificate(i: int) -> Column:
        return _struct(
            schema.CERTIFICATION, name=_pick(k + i, CERTS), issuer=_pick(k + i, ISSUERS), year=2010 + (k + i) % 14,
        )

    scores = F.create_map(*[c for t, n in ASSESSMENTS.items() for c in (F.lit(n), F.col(f"avg_{t}"))])
    salary = F.when(k % 5 != 0, _struct(schema.SALARY, min=10 + k % 40, max=12 + k % 57))
    signals = _struct(
        schema.SIGNALS,
        profile_completeness_score=F.when(k % 59 != 0, k % 101),
        signup_date=F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int")).cast("string"),
        last_active_date=F.coalesce(
            F.col("last_ts").cast("date").cast("string"),
            F.when(k % 29 != 0, F.date_add(F.lit("2023-06-01").cast("date"), (k % 240).cast("int")).cast("string")),
        ),
        open_to_work_flag=k % 3 == 0,
        profile_views_received_30d=F.col("n_events"), applications_submitted_30d=k % 9,
        recruiter_response_rate=F.when(k % 31 != 0, (k % 20) / F.lit(20.0)), avg_response_time_hours=F.col("avg_value"),
        skill_assessment_scores=F.when(F.col("n_events").isNotNull(), F.map_filter(scores, lambda _, v: v.isNotNull())),
        connection_count=k % 500, endorsements_received=F.floor(F.abs(F.col("c_acctbal")) / 100),
        notice_period_days=F.when(k % 37 != 0, (k % 7) * 15), expected_salary_range_inr_lpa=salary,
        preferred_work_mode=_pick(k, MODES), willing_to_relocate=F.when(k % 6 != 5, k % 6 < 3),
        github_activity_score=F.when(k % 4 == 0, -1).when(k % 37 != 0, k % 100),
        search_appearance_30d=k % 80, saved_by_recruiters_30d=k % 12,
        interview_completion_rate=(k % 10) / F.lit(10.0),
        offer_acceptance_rate=F.when(k % 5 == 0, -1).otherwise((k % 4) / F.lit(4.0)),
        verified_email=k % 2 == 0, verified_phone=k % 3 == 0, linkedin_connected=k % 4 == 0,
    )
    return joined.select(
        F.concat(F.lit("CAND_"), F.lpad(k.cast("string"), 7, "0")).alias(schema.ID),
        profile.alias("profile"), "career_history",
        F.slice(F.array(education(0), education(1)), F.lit(1), (k % 3).cast("int")).alias("education"),
        "skills",
        F.slice(F.array(*[certificate(i) for i in range(3)]), F.lit(1), (k % 4).cast("int")).alias("certifications"),
        signals.alias("signals"),
    )


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool as a stored table, built once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _POOLS:
        _POOLS[key] = materialize(build_pool(spark, sf_dir), "pool", keep=True, compression="zstd")
    return _POOLS[key]


def _sql_pick(index: str, values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][(({index}) % {len(values)} + 1)::INT]"


def _pool_sql() -> str:
    def edu(i: int) -> str:
        start = f"(2000 + (k + {i}) % 15)"
        return (
            f"{{'degree': {_sql_pick(f'k + {i}', DEGREES)}, 'field_of_study': {_sql_pick(f'k + {i}', FIELDS)}, "
            f"'institution': 'University ' || (k % 30), 'start_year': {start}::INT, "
            f"'end_year': (CASE WHEN k % 61 = 0 THEN {start} - 1 ELSE {start} + 4 END)::INT, 'tier': {_sql_pick(f'k + {i}', TIERS)}}}"
        )

    def cert(i: int) -> str:
        return f"{{'name': {_sql_pick(f'k + {i}', CERTS)}, 'issuer': {_sql_pick(f'k + {i}', ISSUERS)}, 'year': (2010 + (k + {i}) % 14)::INT}}"

    def mean(x: str) -> str:
        return f"floor(sum(round(({x}) * 100)::BIGINT)::BIGINT // nullif(count({x}), 0)) / 100.0::DOUBLE"

    averages = ", ".join(
        f"{mean(f"CASE WHEN event_type = '{t}' THEN value END")} AS avg_{t}" for t in ASSESSMENTS
    )
    scores = ", ".join(f"{{'name': '{n}', 'score': avg_{t}}}" for t, n in ASSESSMENTS.items())
    def place(key: str) -> tuple[str, str]:
        at = f"({key} % 40)"
        steps = list(enumerate(FIRST_SLOTS))[::-1]
        number = "CASE " + " ".join(f"WHEN {at} >= {s} THEN {i}" for i, s in steps) + " END"
        first = "CASE " + " ".join(f"WHEN {at} >= {s} THEN {s}" for _, s in steps) + " END"
        return f"(({key} // 40) * 4 + {number})", f"({at} - {first})"

    record, slot = place("o_orderkey")
    return f"""
placed AS (SELECT o_orderkey AS o, {record} AS record, {slot} AS slot, o_orderdate FROM orders),
role_dates AS (
  SELECT o, record, slot, (slot = 0 OR (slot = 1 AND record % 17 = 0)) AS cur,
         (o_orderdate::DATE + INTERVAL 264 MONTH)::DATE AS s
  FROM placed),
role_ends AS (
  SELECT *, CASE WHEN cur THEN DATE '2024-02-15'
                 ELSE least((s + to_months((1 + (o * 7) % 30)::INT))::DATE, DATE '2024-02-15') END AS e
  FROM role_dates),
role_rows AS (
  SELECT record, slot, {{'company': {_sql_pick('o', COMPANIES)}, 'title': {_sql_pick('o // 3', TITLES)},
    'start_date': CASE WHEN o % 41 = 0 THEN '2024-02-30' WHEN o % 43 <> 0 THEN s::VARCHAR END,
    'end_date': (CASE WHEN cur AND o % 71 <> 0 THEN NULL WHEN o % 97 = 0 THEN (e - INTERVAL 40 MONTH)::DATE ELSE e END)::VARCHAR,
    'duration_months': (CASE WHEN o % 23 <> 0 THEN (year(e) - year(s)) * 12 + month(e) - month(s)
                        + CASE WHEN o % 19 = 0 THEN 6 ELSE 0 END END)::DOUBLE,
    'is_current': cur, 'industry': {_sql_pick('o // 7', INDUSTRIES)}, 'company_size': {_sql_pick('o // 11', SIZES)},
    'description': {_sql_pick('o // 5', DESCRIPTIONS)}}} AS r
  FROM role_ends),
role_lists AS (SELECT record, list(r ORDER BY slot) AS career_history FROM role_rows GROUP BY record),
lines AS (
  SELECT l_orderkey, l_linenumber % 4 AS slot, min(l_partkey) AS p, max(l_suppkey) AS s, max(l_quantity) AS q, count(*) AS n
  FROM lineitem GROUP BY l_orderkey, l_linenumber % 4),
skill_rows AS (
  SELECT {place('l_orderkey')[0]} AS record, l_orderkey, slot,
    {{'name': {_sql_pick('p', SKILLS)}, 'proficiency': {_sql_pick('p // 5', PROFICIENCIES)},
      'duration_months': (CASE WHEN s % 41 <> 0 THEN CASE WHEN p % 89 = 0 THEN (q - 1) * 20 ELSE q - 1 END END)::DOUBLE,
      'endorsements': (s % 60 + n)::DOUBLE}} AS r
  FROM lines),
skill_lists AS (SELECT record, list(r ORDER BY l_orderkey, slot) AS skills FROM skill_rows GROUP BY record),
activity AS (
  SELECT user_id AS record, count(*) AS n_events, max(ts) AS last_ts, {mean('value')} AS avg_value, {averages}
  FROM events GROUP BY user_id),
base AS (
  SELECT c_custkey AS k, * FROM customer
  LEFT JOIN role_lists r ON r.record = c_custkey LEFT JOIN skill_lists s ON s.record = c_custkey
  LEFT JOIN activity a ON a.record = c_custkey LEFT JOIN documents d ON d.doc_id = c_custkey),
pool AS (
  SELECT 'CAND_' || lpad(k::VARCHAR, 7, '0') AS candidate_id,
  {{'headline': CASE WHEN k % 13 = 0 THEN '' ELSE {_sql_pick('k', TITLES)} || ' | ' || c_mktsegment END,
    'summary': CASE WHEN k % 11 = 0 THEN 'Short bio' ELSE coalesce(text, 'Works on ' || {_sql_pick('k // 3', DESCRIPTIONS)}) END,
    'location': CASE WHEN k % 47 <> 0 THEN {_sql_pick('k', CITIES)} END,
    'country': CASE WHEN k % 10 < 8 THEN 'India' ELSE 'Elsewhere' END,
    'years_of_experience': CASE WHEN k % 53 <> 0 THEN 1 + (k % 150) / 10.0::DOUBLE END,
    'current_title': {_sql_pick('k', TITLES)}, 'current_company': {_sql_pick('k', COMPANIES)},
    'current_company_size': {_sql_pick('k', SIZES)}, 'current_industry': {_sql_pick('k', INDUSTRIES)}}} AS profile,
  coalesce(career_history, []) AS career_history,
  ([{edu(0)}, {edu(1)}])[1:(k % 3)] AS education,
  coalesce(skills, []) AS skills,
  ([{cert(0)}, {cert(1)}, {cert(2)}])[1:(k % 4)] AS certifications,
  {{'profile_completeness_score': (CASE WHEN k % 59 <> 0 THEN k % 101 END)::DOUBLE,
    'signup_date': (DATE '2020-01-01' + (k % 1000)::INT)::VARCHAR,
    'last_active_date': coalesce(last_ts::DATE::VARCHAR, CASE WHEN k % 29 <> 0 THEN (DATE '2023-06-01' + (k % 240)::INT)::VARCHAR END),
    'open_to_work_flag': k % 3 = 0, 'profile_views_received_30d': n_events::DOUBLE,
    'applications_submitted_30d': (k % 9)::DOUBLE,
    'recruiter_response_rate': CASE WHEN k % 31 <> 0 THEN (k % 20) / 20.0::DOUBLE END,
    'avg_response_time_hours': avg_value,
    'scores': CASE WHEN n_events IS NULL THEN [] ELSE list_filter([{scores}], lambda x: x.score IS NOT NULL) END,
    'connection_count': (k % 500)::DOUBLE, 'endorsements_received': floor(abs(c_acctbal) / 100)::DOUBLE,
    'notice_period_days': (CASE WHEN k % 37 <> 0 THEN (k % 7) * 15 END)::DOUBLE,
    'salary': CASE WHEN k % 5 <> 0 THEN {{'lo': (10 + k % 40)::DOUBLE, 'hi': (12 + k % 57)::DOUBLE}} END,
    'preferred_work_mode': {_sql_pick('k', MODES)},
    'willing_to_relocate': CASE WHEN k % 6 <> 5 THEN k % 6 < 3 END,
    'github_activity_score': (CASE WHEN k % 4 = 0 THEN -1 WHEN k % 37 <> 0 THEN k % 100 END)::DOUBLE,
    'search_appearance_30d': (k % 80)::DOUBLE, 'saved_by_recruiters_30d': (k % 12)::DOUBLE,
    'interview_completion_rate': (k % 10) / 10.0::DOUBLE,
    'offer_acceptance_rate': CASE WHEN k % 5 = 0 THEN -1 ELSE (k % 4) / 4.0::DOUBLE END,
    'verified_email': k % 2 = 0, 'verified_phone': k % 3 = 0, 'linkedin_connected': k % 4 = 0}} AS signals
  FROM base)"""


# Common table expressions that end in ``pool``; NULL lists are empty there.
POOL_SQL = _pool_sql()
