"""Personal data by weak supervision, in DataFrame functions only.

Base spans follow fixed patterns and checks (email, ip, card, phone) and always stay. The search
also keeps matches that fail a check and looser forms as candidates: spelled-out addresses, masked and
six-group network addresses, cards split by other signs or of 15 digits, phone numbers without a country code.
Six labelers vote on every candidate or abstain: the strict pattern (not on looser forms), a
gazetteer (top-level domains, card issuers, country codes, address ranges), the words before it,
its borders, the check digit, and the variety of its digits. Expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is; its posteriors weight the training rows of a logistic regression over votes and shape,
which decides on the candidates: those scoring at least ``CERTAIN`` that no base span overlaps are
added, if it is of a looser form and begins after the one before
it ends. Counts are taken over all documents; the tables of patterns have a fixed number of rows.

Starts and ends are code points, from the lengths of the matches and of the text between them. The
patterns begin at the border of a run or where the last match ended and take runs possessively. This
finds the same matches, and long runs cost linear time and no deep recursion.

Null texts are empty; rows with equal ids are searched one by one; a null doc_id stays null.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.session import stored

KINDS = ("email", "ip", "card", "phone")
CERTAIN = 0.9
EM_ROUNDS = 60
#: Characters before a candidate that the context labeler reads.
CONTEXT = 40

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Per kind, forms without a check of their own.
LOOSE = {
    "email": (
        rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+ ?[\[({{<] ?(?i:at|@) ?[\])}}>] ?[A-Za-z0-9-]{{1,63}}+"
        r"(?: ?(?:[\[({<] ?(?i:dot|\.) ?[\])}>]|\.) ?[A-Za-z0-9-]{1,63}+){1,8}",
        rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+ (?i:at) [A-Za-z0-9-]{{1,63}}+(?: (?i:dot) [A-Za-z0-9-]{{1,63}}+){{1,8}}",
        rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+(?: @ ?|@ | ?＠ ?)[A-Za-z0-9-]{{1,63}}+(?:\.[A-Za-z0-9-]{{1,63}}+){{1,8}}",
    ),
    "ip": (
        r"(?<![0-9.])[0-9]{1,3}(?: ?[\[({] ?(?i:dot|\.) ?[\])}] ?[0-9]{1,3}){3}(?![0-9.])",
        r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])",
    ),
    "card": (
        r"(?<![0-9])[0-9]{16}(?![0-9])",
        r"(?<![0-9])[0-9]{4}(?:(?: ?[./_|–-] ?| {1,2})[0-9]{4}){3}(?![0-9])",
        r"(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])",
    ),
    "phone": (
        r"\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])",
        r"(?<![0-9+.-])(?<!\+[0-9]{1,3}[ .-])(?:1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
        r"(?<![0-9+.-])00[1-9][0-9]{0,2}(?:[ .-]?[0-9]){6,12}(?![0-9])",
        r"(?<![0-9+.-])\(?0[1-9][0-9]{1,3}\)?[ /-][0-9]{3,4}[ -]?[0-9]{3,5}(?![0-9])",
    ),
}
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
TOP_LEVEL = (
    r"(?i)(?:\.|dot|[\])}>]) ?(?:com|org|net|edu|gov|mil|int|info|biz|io|co|me|tv|app|dev|name|pro|xyz|online|site|example|test|"
    r"us|uk|de|fr|es|it|nl|ch|at|be|eu|ca|au|jp|in|br|mx|se|no|fi|dk|pl|cz|pt|ie|gr|ro|hu|ru|ua|tr|il|za|nz|sg|hk|kr|cn|tw|ar|cl)$"
)
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|6011|65|62)"
COUNTRIES = r"^(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RANGES = r"^(?:0*(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])[^0-9A-Fa-f:]|(?i:[23][0-9a-f]{3}|f[cd][0-9a-f]{2}|fe80):)"
CUES = (
    r"\b(?:e-?mails?|mailto|contact|reach|write|call|phone|telephone|mobile|cell|tel|fax|dial|ring|text|whatsapp|sms|"
    r"cards?|visa|mastercard|amex|pay|paid|credit|debit|charged?|address|host|server|from|ip|ipv[46]|ping|login|client|user)"
    r"(?:\W+(?:me|us|him|her|them|at|on|is|was|to|via|with|by|number|no|address|the|my|your|our|his|their)){0,3}\W*$"
)
OTHER_CUES = r"(?:version|release|isbn|issn|order|invoice|serial|number|no|id|token|key|hash|sha|build|page|section|figure|table|v)\W*$"

VOTES = ("by_rule", "by_list", "by_context", "by_border", "by_sum", "by_variety")
#: Elements that one running sum takes at a time.
BLOCK = 128


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    value = F.transform(reverse, lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(value, F.lit(0), lambda total, v: total + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def _strict(kind: str, match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": n.between(16, 19) & _luhn(digits),
        "phone": n.between(8, 15),
    }[kind]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column) -> Column:
    """Sums of an array up to and with each element, block by block, so that cost stays in line with length."""

    def sums(part: Column, base: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            at = state["at"] + x
            return F.struct(at.alias("at"), F.concat(state["all"], F.array(at)).alias("all"))

        first = F.struct(base.alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(part, first, step, lambda state: state["all"])

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def in_blocks(v: Column) -> Column:
        last = F.floor((F.greatest(F.size(v), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))

    def joined(blocks: Column) -> Column:
        bases = F.concat(F.array(F.lit(0)), sums(F.transform(blocks, total), F.lit(0)))
        return _let(bases, lambda base: F.flatten(F.transform(blocks, lambda part, i: sums(part, base[i]))))

    return _let(values, lambda v: _let(in_blocks(v), joined))


def _spans(text: Column, pattern: str, kind: str, loose: bool) -> Column:
    """Matches of a pattern as (kind, start, end, match, loose, rule, before, after)."""
    none = F.array().cast(
        "array<struct<kind:string,start:int,end:int,match:string,loose:boolean,rule:boolean,before:string,after:string>>"
    )

    def located(found: Column) -> Column:
        """Texts between matches are one more than these; each text and match is measured once."""
        pairs = F.zip_with(found["gaps"], found["matches"], lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
        return F.zip_with(found["matches"], F.slice(_running(pairs), F.lit(1), F.size(found["matches"])), lambda m, end: (
            F.struct(m.alias("match"), end.alias("end"))
        ))

    def spans(found: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            match, gaps = m["match"], found["gaps"]
            near = F.concat(F.coalesce(F.get(found["matches"], i - 1), F.lit("")), gaps[i])
            return F.struct(
                F.lit(kind).alias("kind"),
                (m["end"] - F.length(match)).alias("start"),
                m["end"].alias("end"),
                match.alias("match"),
                F.lit(loose).alias("loose"),
                (F.lit(False) if loose else _strict(kind, match)).alias("rule"),
                F.lower(F.substring(near, -CONTEXT, CONTEXT)).alias("before"),
                F.substring(F.concat(gaps[i + 1], F.coalesce(F.get(found["matches"], i + 1), F.lit(""))), 1, 1).alias("after"),
            )

        return F.transform(located(found), span)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.struct(matches.alias("matches"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(pattern), _let(found, spans)).otherwise(none)


def find(documents: DataFrame) -> DataFrame:
    """(doc_id, found): per document its matches, base ones first, by kind and start."""
    text = F.col("text")
    parts = [_spans(text, PATTERNS[k], k, False) for k in KINDS]
    parts += [_spans(text, p, k, True) for k, forms in LOOSE.items() for p in forms]
    body = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return body.select("doc_id", F.concat(*parts).alias("found"))


def _votes(c: Column) -> dict[str, Column]:
    """What each labeler says of a candidate: 1, 0, or -1 for nothing."""
    kind, match = c["kind"], c["match"]
    listed = (
        F.when(kind == "email", F.when(match.rlike(TOP_LEVEL), 1).otherwise(0))
        .when(kind == "ip", F.when(match.rlike(RANGES), 1).otherwise(0))
        .when(kind == "card", F.when(_digits(match).rlike(ISSUERS), 1).otherwise(0))
        .when(~match.rlike(r"^(?:\+|00)"), -1)
        .otherwise(F.when(match.rlike(COUNTRIES), 1).otherwise(0))
    )
    context = F.when(c["before"].rlike(CUES), 1).when(c["before"].rlike(OTHER_CUES), 0).otherwise(-1)
    open_ = ~c["before"].rlike(r"[\p{L}\p{N}_.]$") & ~c["after"].rlike(r"[\p{L}\p{N}_]")
    digits = _digits(match)
    few = digits.rlike("^([0-9])\\1*([0-9]?)(?:\\1|\\2)*$")
    return {
        "by_rule": F.when(c["loose"], -1).otherwise(c["rule"].cast("int")),
        "by_list": listed,
        "by_context": context,
        "by_border": open_.cast("int"),
        "by_sum": F.when(kind == "card", _luhn(digits).cast("int")).otherwise(-1),
        "by_variety": F.when(kind.isin("card", "phone") & few, 0).otherwise(-1),
    }


def _features(c: Column) -> dict[str, Column]:
    """Numbers from a small set, for the classifier."""
    votes = _votes(c)
    out = {f"is_{k}": (c["kind"] == k).cast("int") for k in KINDS}
    for name, vote in votes.items():
        out |= {f"{name}_yes": (vote == 1).cast("int"), f"{name}_no": (vote == 0).cast("int")}
    out["grouped"] = c["match"].rlike("[0-9][ -][0-9]").cast("int")
    out["digits"] = F.least(F.length(_digits(c["match"])), F.lit(20)) / 20
    return out


def reliabilities(table: list[tuple[str, tuple[int, ...], int]]) -> tuple[dict, dict, list[float]]:
    """Shares of true candidates per kind, (sensitivity, specificity) per labeler, and the rows' posteriors.

    ``table`` has (kind, votes, count). Expectation-maximisation with a weak prior that labelers are
    better than chance; a vote of -1 says nothing.
    """
    share = {k: 0.5 for k, _, _ in table}
    skill = {v: [0.95, 0.95] if v == "by_rule" else [0.8, 0.7] for v in VOTES}
    posterior: list[float] = []
    for _ in range(EM_ROUNDS):
        posterior = []
        for kind, votes, _ in table:
            yes, no = math.log(share[kind]), math.log(1 - share[kind])
            for name, vote in zip(VOTES, votes):
                sensitive, specific = skill[name]
                if vote >= 0:
                    yes += math.log(sensitive if vote else 1 - sensitive)
                    no += math.log(1 - specific if vote else specific)
            posterior.append(1 / (1 + math.exp(min(700.0, no - yes))))
        for kind in share:
            mine = [(p, n) for p, (k, _, n) in zip(posterior, table) if k == kind]
            share[kind] = (1 + sum(p * n for p, n in mine)) / (2 + sum(n for _, n in mine))
        for at, name in enumerate(VOTES):
            spoke = [(p, v[at], n) for p, (_, v, n) in zip(posterior, table) if v[at] >= 0]
            strong = 18, 20
            skill[name] = [
                (strong[0] + sum(p * n for p, v, n in spoke if v)) / (strong[1] + sum(p * n for p, _, n in spoke)),
                (strong[0] + sum((1 - p) * n for p, v, n in spoke if not v))
                / (strong[1] + sum((1 - p) * n for p, _, n in spoke)),
            ]
    return share, skill, posterior


def train(found: DataFrame) -> dict[str, float] | None:
    """Weights of the span classifier by feature name, with ``intercept``; None without candidates."""
    candidate = found.select(F.explode("found").alias("c"))
    votes, features = _votes(F.col("c")), _features(F.col("c"))
    names = list(features)
    rows = candidate.select(
        F.col("c.kind").alias("kind"), *(v.alias(k) for k, v in votes.items()), *(v.alias(k) for k, v in features.items())
    )
    # kinds, votes and shapes have a fixed number of combinations
    table = rows.groupBy("kind", *VOTES, *names).count().orderBy("kind", *VOTES, *names).collect()
    if not table:
        return None
    _, _, posterior = reliabilities([(r["kind"], tuple(r[v] for v in VOTES), r["count"]) for r in table])
    weighted = []
    for row, p in zip(table, posterior):
        values = [float(row[f]) for f in names]
        weighted += [(1.0, max(1e-9, row["count"] * p), *values), (0.0, max(1e-9, row["count"] * (1 - p)), *values)]
    schema = ", ".join(f"{c} double" for c in ("label", "weight", *names))
    training = VectorAssembler(inputCols=names, outputCol="features").transform(
        found.sparkSession.createDataFrame(weighted, schema)
    )
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(training)
    return dict(zip(names, model.coefficients.toArray().tolist())) | {"intercept": model.intercept}


def _score(c: Column, weights: dict[str, float]) -> Column:
    terms = [F.lit(weights[name]) * value for name, value in _features(c).items()]
    z = reduce(lambda a, b: a + b, terms, F.lit(weights["intercept"]))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def detect(documents: DataFrame) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end), each by kind and then start."""
    found = stored(find(documents), "private-candidates")
    weights = train(found)

    def spans(chosen: Column) -> Column:
        plain = F.transform(chosen, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
        # one kind after the other, as listed; each by start
        return F.concat(*(F.array_sort(of_kind(plain, k)) for k in KINDS))

    base = F.filter("found", lambda c: c["rule"])
    with_base = found.select("doc_id", "found", spans(base).alias("base"))
    if weights is None:
        return with_base.select("doc_id", "base", F.filter("base", lambda s: F.lit(False)).alias("added"))
    free = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    sure = F.filter("found", lambda c: c["loose"] & (_score(c, weights) >= CERTAIN) & free(c))
    by_place = F.array_sort(F.transform(sure, lambda c: F.struct(*(c[f].alias(f) for f in ("start", "end", "kind")))))

    def first_of_its_place(spans_: Column) -> Column:
        return F.filter(spans_, lambda c, i: (i == 0) | (c["start"] >= F.get(spans_, i - 1)["end"]))

    return with_base.select("doc_id", "base", spans(_let(by_place, first_of_its_place)).alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def in_kind_order(a: Column, b: Column) -> Column:
    """Two arrays of spans as one, by kind as listed and then start."""
    both = F.concat(a, b)
    return F.concat(*(F.array_sort(of_kind(both, k)) for k in KINDS))
