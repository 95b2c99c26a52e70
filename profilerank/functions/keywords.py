"""Keyword families: how many distinct patterns of a family a text contains.

Texts are lower-cased before they get here, so the patterns need no case flag. Most patterns
never occur in most texts, and a regular expression scan of a long text costs far more than a
byte search. Each pattern is therefore guarded by a literal every match must contain, found from
the parsed pattern, and the expression runs only on texts that hold the literal.

For scans with many patterns the words of a text are intersected once with the words the patterns
ask for (``token_hits``). Patterns that are one whole word are then decided by that short list, and
most others are ruled out by it, without reading the text again.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, functions as F

# --- fixed values: keyword families and their patterns ---
FAMILIES: dict[str, list[str]] = {
    "retrieval_embeddings": [
        r"\bembeddings?\b", r"\bsentence[\s\-]?transformers?\b", r"\bbge\b",
        r"\be5\b", r"\bdense retrieval\b", r"\bsemantic search\b",
        r"\bbi[\s\-]?encoders?\b", r"\bcross[\s\-]?encoders?\b", r"\brag\b",
        r"retrieval[\s\-]?augmented", r"\bvector search\b",
        r"openai embeddings?", r"\bword2vec\b", r"\bdoc2vec\b",
        r"\bann\b.{0,15}\bsearch\b", r"approximate nearest neighbou?r",
    ],
    "vector_db_hybrid_search": [
        r"\bpinecone\b", r"\bweaviate\b", r"\bqdrant\b", r"\bmilvus\b",
        r"\bfaiss\b", r"\bopensearch\b", r"\belasticsearch\b",
        r"\bhybrid search\b", r"vector database", r"\bann index\b",
    ],
    "evaluation_ranking_metrics": [
        r"\bndcg\b", r"\bmrr\b", r"mean average precision", r"\bmap@\d+",
        r"precision@\d+", r"\bp@\d+\b", r"\ba/b test", r"\bab test",
        r"offline.{0,20}online correlation", r"offline evaluation",
        r"recall@\d+", r"learning[\s\-]to[\s\-]rank",
    ],
    "llm_finetuning": [
        r"\block?ra\b", r"\bq?lora\b", r"\bpeft\b", r"adapter tuning",
        r"fine[\s\-]?tun(e|ing|ed)",
    ],
    "learning_to_rank_models": [
        r"lambdamart", r"\bxgboost\b.{0,20}rank", r"listwise rank",
        r"pairwise rank", r"neural ranker", r"learning[\s\-]to[\s\-]rank",
    ],
    "distributed_inference": [
        r"\bkubernetes\b", r"\bk8s\b", r"multi[\s\-]?gpu", r"\btriton\b",
        r"\bvllm\b", r"\btensorrt\b", r"model serving", r"inference optimi[sz]ation",
        r"\bqps\b", r"latency.{0,15}(slo|sla|optimi[sz])",
    ],
    "open_source_validation": [
        r"open[\s\-]?source", r"\bgithub\b", r"published a paper",
        r"\bconference talk\b", r"tech talk", r"\bblog post\b",
        r"contributed to", r"maintainer of",
    ],
    "nlp_ir_domain": [
        r"\bnlp\b", r"natural language processing", r"information retrieval",
        r"\bsearch ranking\b", r"\btext classification\b", r"\btopic model",
        r"\bnamed entity\b", r"\bner\b",
    ],
    "cv_speech_robotics_domain": [
        r"computer vision", r"\bopencv\b", r"image classification",
        r"object detection", r"speech recognition", r"\basr\b",
        r"\brobotics?\b", r"autonomous (vehicle|driving|navigation)",
        r"\blidar\b", r"\bslam\b",
    ],
    "production_deployment": [
        r"\bproduction\b", r"\bdeployed?\b", r"shipped to", r"real users",
        r"at scale", r"\bmillions of (users|queries|requests)\b",
        r"\blive system\b", r"\btraffic\b",
    ],
    "research_only": [
        r"\bpostdoc\b", r"\bph\.?d\.?\b", r"research scientist",
        r"academic lab", r"\bacademia\b", r"published.{0,15}paper",
    ],
    "pre_llm_ml_background": [
        r"machine learning", r"deep learning", r"recommendation system",
        r"\bclassifier\b", r"\bregression model\b", r"search ranking",
        r"\bnlp\b", r"computer vision",
    ],
    "llm_only_recent": [
        r"\blangchain\b", r"\bopenai api\b", r"\bgpt[\s\-]?[34]\b",
        r"\bchatgpt\b", r"\banthropic\b", r"\bllm\b",
    ],
    "code_quality_signals": [
        r"code review", r"\bci/cd\b", r"continuous integration",
        r"unit test", r"\btest coverage\b", r"\bopen[\s\-]?source\b",
    ],
    "hr_recruiting_marketplace_domain": [
        r"\bhr tech\b", r"recruit(ing|ment)", r"\btalent\b",
        r"\bmarketplace\b", r"two[\s\-]?sided", r"\bats\b",
        r"job board", r"candidate matching",
    ],
    "marketing_nontech_titles": [
        r"\bmarketing\b", r"\bsales\b", r"account manager",
        r"\bhuman resources\b", r"\bhr\b generalist", r"\bfinance\b",
        r"business analyst",
    ],
    "management_architect_titles": [
        r"\barchitect\b", r"\btech lead\b", r"\bhead of\b", r"\bdirector\b",
        r"\bvp\b", r"\bmanager\b", r"\bengineering manager\b",
    ],
    "title_chasing_seniority_words": [
        r"\bsenior\b", r"\bstaff\b", r"\bprincipal\b", r"\blead\b",
    ],
}

# --- fixed values: substring lists ---
SERVICE_FIRMS = [
    "tcs", "tata consultancy", "infosys", "wipro", "accenture", "cognizant",
    "capgemini", "hexaware", "mphasis", "hcl", "tech mahindra", "mindtree",
    "ltimindtree", "l&t infotech",
]
TECH_INDUSTRIES = [
    "software", "internet", "saas", "information technology", "ai", "ml",
    "fintech", "edtech", "e-commerce", "ecommerce", "technology",
]
SERVICE_INDUSTRIES = ["it services", "consulting", "staffing", "outsourcing", "bpo"]
DEGREE_FIELDS = [
    "computer science", "information technology", "data science",
    "electronics", "mathematics", "statistics", "artificial intelligence",
]
CERT_VENDORS = ["aws", "gcp", "google cloud", "azure", "deep learning"]


@lru_cache(maxsize=None)
def _pieces(pattern: str) -> list[tuple[str, str]]:
    """The parts of a pattern in order: (char, a letter that must be there), (edge, "") for a word boundary, (anchor, "")
    for the start or end of the text, and (other, "") for whatever may vary."""
    out, at, size = [], 0, len(pattern)
    while at < size:
        sign, end = pattern[at], at + 1
        piece = ("char", sign)
        if sign == "|":
            return [("other", "")]  # alternatives share nothing that is looked for here
        if sign == "\\":
            sign, end = pattern[end], end + 1
            piece = ("edge", "") if sign == "b" else ("other", "") if sign.isalnum() else ("char", sign)
        elif sign == "[":
            end, piece = pattern.index("]", at + 2) + 1, ("other", "")
        elif sign == "(":
            depth = 1
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[end], 0) if pattern[end - 1] != "\\" else 0
                end += 1
            piece = ("other", "")
        elif sign in "^$":
            piece = ("anchor", "")
        elif sign == ".":
            piece = ("other", "")
        while end < size and pattern[end] in "?*+{":  # a repeated part may be absent
            end = pattern.index("}", end) + 1 if pattern[end] == "{" else end + 1
            piece = ("other", "")
        out.append(piece)
        at = end
    return out


@lru_cache(maxsize=None)
def required_literal(pattern: str) -> str:
    """The longest run of plain characters that every match of ``pattern`` contains."""
    runs, run = [], ""
    for kind, sign in _pieces(pattern):
        if kind == "char":
            run += sign
        elif kind == "other":  # a word boundary does not interrupt the run
            runs.append(run)
            run = ""
    return max([*runs, run], key=len)


@lru_cache(maxsize=None)
def required_token(pattern: str) -> str | None:
    """The longest whole word that every match of ``pattern`` contains, or None.

    A run of word characters is a whole word when a word boundary or another plain character stands
    on both of its sides.
    """
    found, run, closed = [], "", False  # closed: whether the left side of the run is delimited
    for kind, sign in _pieces(pattern):
        if kind == "char" and (sign.isalnum() or sign == "_"):
            run += sign
            continue
        delimits = kind in ("char", "edge")
        if run and closed and delimits:
            found.append(run)
        run, closed = "", delimits
    return max(found, key=len, default=None)


def guard_token(pattern: str) -> str | None:
    """The word to look for first: any word of three letters, or one that is the whole pattern."""
    token = required_token(pattern)
    return token if token and (len(token) >= 3 or pattern == rf"\b{token}\b") else None


def token_hits(text: str, patterns: list[str]) -> Column:
    """The words of ``text`` (lower case) among the guard words of the patterns, as a short text.

    Each word stands between two blanks: a byte search in this text is faster than one in an array.
    """
    wanted = sorted({t for p in patterns if (t := guard_token(p))})
    words = ", ".join(f"'{t}'" for t in wanted)
    found = f"array_intersect(split(coalesce({text}, ''), r'[^\\p{{L}}\\p{{N}}_]+'), array({words}))"
    return F.expr(f"concat(' ', array_join({found}, ' '), ' ')")


def _literal(text: str) -> str:
    """A SQL literal that is taken as it stands."""
    quote = "'" if "'" not in text else '"'
    return f"r{quote}{text}{quote}"


def kw_found(text: str, pattern: str, tokens: str | None = None) -> str:
    """SQL condition: whether the pattern occurs in ``text``, a SQL expression of a lower-cased text.

    ``tokens`` is the column with the text's ``token_hits``, if there is one.
    """
    match = f"rlike({text}, {_literal(pattern)})"
    if tokens and (token := guard_token(pattern)):
        held = f"contains({tokens}, ' {token} ')"
        return held if pattern == rf"\b{token}\b" else f"({held} AND {match})"
    literal = required_literal(pattern)
    if not literal:
        return match
    held = f"contains({text}, {_literal(literal)})"
    return held if literal == pattern else f"({held} AND {match})"


# The conditions are SQL text, because a table of some 400 of them is built much faster as a few
# parsed expressions than as thousands of calls into the JVM.


def kw_hits(text: str, patterns: list[str], tokens: str | None = None) -> Column:
    """Number of distinct patterns that occur in the text; 0 for NULL."""
    return F.expr(" + ".join(f"coalesce(int({kw_found(text, p, tokens)}), 0)" for p in patterns))


def kw_any_sql(text: str, patterns: list[str], tokens: str | None = None) -> str:
    return "coalesce(" + " OR ".join(kw_found(text, p, tokens) for p in patterns) + ", false)"


def kw_any(text: str, patterns: list[str], tokens: str | None = None) -> Column:
    """Whether any pattern occurs; evaluation stops at the first hit."""
    return F.expr(kw_any_sql(text, patterns, tokens))


def inflation_gap(skills_hits: Column, narrative_hits: Column) -> Column:
    """How many more patterns the skill list claims than the narrative shows."""
    return F.greatest(F.lit(0), skills_hits - narrative_hits)
