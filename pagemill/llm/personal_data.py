"""Personal data in texts, in Spark expressions only: labelers vote on the candidates of seven kinds, weakly supervised.

Candidates. Rules (fixed) give e-mail addresses, IP addresses, card and phone numbers; these are always reported. Further
kinds are ``secret`` (runs of eight or more of ``[A-Za-z0-9+/_-]`` with a digit), ``person`` (a title or a given name before
capitalised words) and ``address`` (a house number and a street word); they are candidates where they touch no span of the rules.

Labelers. Six of them vote on each candidate of every kind (1 yes, -1 no, 0 none): a strict pattern of the kind; a pattern of
numbers, dates and versions; a gazetteer of words that introduce the kind; a gazetteer of words that introduce something
else; the context right before (assignment, quotation mark, colon); the mixture of characters. Candidates of one kind with equal votes are
counted; expectation-maximisation over these at most 7 * 729 patterns estimates for each kind how often each labeler is
right for either class, and gives each pattern a probability. These soft labels train a final classifier of each kind, naive
Bayes over eight features of the span in at most ten values each, whose log-odds become literals in the last projection. Each
span carries its log-odds; of the further kinds those at ``least`` are reported.

Defined results: a null or empty text has no spans; spans of one kind never overlap, those of different rules may; an
added span overlaps none of the rules; a null doc_id is returned; repeated rows are judged each; other columns are
ignored. Without candidates nothing is added.

Scale: one pass over the texts; spans and candidates go to a narrow table. What reaches the driver is counts of vote
patterns and feature values, bounded by their number of possible values.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import stage, text_of
from pagemill.llm.expressions import find_all

KINDS = ("email", "ip", "card", "phone", "secret", "person", "address")
#: The first four are given by rules.
N_RULES = 4
# The look-behinds and possessive repeats only forbid starts that fail or were tried: a later start in the same run sees
# the same rest. \G lets a match begin where the last one ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SECRET = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{8,}+"
OCTET = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"

TITLES = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Madam|Herr|Frau|Monsieur|Madame|Mme|Mlle|Señor|Señora|Sra|Don|Doña)"
GIVEN = (
    "Alice|Anna|Antonio|Ben|Carlos|Carmen|Charles|Claire|Daniel|David|Elena|Elizabeth|Emily|Emma|Eva|Francisco|Hans|Henry|Isabel|Jack|James|"
    "Jane|Jean|Johann|John|José|Juan|Julia|Karl|Klaus|Laura|Linda|Louis|Lucas|Luis|María|Marie|Mark|Martin|Mary|Michael|Miguel|Monika|Nicolas|"
    "Olivia|Pablo|Paul|Peter|Pierre|Richard|Robert|Sabine|Sarah|Sofia|Sophie|Susan|Thomas|Ursula|William|Wolfgang"
)
NAME = r"\p{Lu}\p{Ll}+(?:[-'’]\p{Lu}\p{Ll}+)?"
PERSON = rf"(?=[A-ZÀ-Þ])(?<!\p{{L}})(?:{TITLES}\.?\x20{NAME}(?:\x20{NAME})?|(?:{GIVEN})\x20(?:\p{{Lu}}\.\x20)?{NAME})(?!\p{{L}})"
STREET = r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive|Court|Square|Way)"
ADDRESS = (
    rf"(?<![\p{{L}}\p{{N}}])(?:[0-9]{{1,5}}[a-zA-Z]?\x20(?:{NAME}\x20){{1,3}}{STREET}|{NAME}(?:straße|strasse|weg|platz|allee|gasse)\x20[0-9]{{1,4}}[a-z]?"
    rf"|[0-9]{{1,4}},?\x20(?:rue|avenue|boulevard|place|chemin)\x20(?:(?:de|du|des|la|le)\x20){{0,2}}{NAME}|(?:Calle|Avenida|Plaza|Paseo)\x20(?:(?:de|del|la)\x20){{0,2}}{NAME},?\x20[0-9]{{1,4}})(?![\p{{L}}\p{{N}}])"
)

#: Of each kind: a test that a text must pass (it begins with what is rare, so that most places fail at once), its pattern, and a pattern that a typical one matches.
SOUGHT = {
    "email": ("@", EMAIL, r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@([A-Za-z0-9-]+\.)+[A-Za-z]{2,12}$"),
    "ip": (r"[0-9]\.[0-9]", IP, r"^([1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])(\.(0|[1-9][0-9]{0,2})){3}$"),
    "card": (r"[0-9][\x20-]?[0-9]", CARD, r"^[2-6][0-9]{3}([\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}$"),
    "phone": ("+", PHONE, r"^\+[1-9][0-9]{0,2}[\x20.-]?(\([0-9]{1,4}\)|[0-9]{1,4})([\x20.-]?[0-9]{2,4}){1,4}$"),
    "secret": ("[0-9]", SECRET, r"^(?=[^A-Za-z]*[A-Za-z])([0-9a-f]{16,}|[0-9A-F]{16,})$|^(sk|pk|ghp|xox[abp]|AKIA|AIza)[A-Za-z0-9_-]{12,}$"),
    "person": (rf"(?=[A-ZÀ-Þ])(?<!\p{{L}})(?:{TITLES}\.?|{GIVEN})\x20\p{{Lu}}", PERSON, rf"^{TITLES}\.?\x20{NAME}\x20{NAME}$|^(?:{GIVEN})\x20"),
    "address": (r"[0-9](?:[a-zA-Z]?\x20\p{Lu}\p{Ll}|,?\x20(?:rue|avenue|boulevard|place|chemin)\x20|(?<=(?:straße|strasse|weg|platz|allee|gasse)\x20[0-9]))|(?=[CAP])(?:Calle|Avenida|Plaza|Paseo)\x20", ADDRESS, r"^[0-9]+|[0-9]+[a-z]?$"),
}
#: Words right before a candidate that speak for its kind, and words that speak for something else.
INTRODUCE = {
    "email": r"e-?mail|mailto|contact|write to|correo|courriel",
    "ip": r"ip|host|server|client|address|from|addr",
    "card": r"card|visa|mastercard|amex|payment|credit|karte|carte|tarjeta",
    "phone": r"tel|phone|call|fax|mobile|cell|contact|telefon|téléphone|teléfono",
    "secret": r"password|passwd|pwd|secret|token|api[_ -]?key|auth|bearer|credential|private[_ -]?key|iban|ssn|passport",
    "person": r"name|author|dear|signed|by|contact|patient|customer|client|regards|attn|hello",
    "address": r"address|lives? at|located at|at|ship to|deliver to|street|resid\w+|wohnhaft|domicile|domicilio",
}
INTRODUCE_NUMBERS = r"(?i)(version|page|chapter|section|figure|table|year|no\.?|release|isbn|doi)\W{0,3}$"
NUMBER = r"^[0-9]+([/_.-][0-9]+)*$"
N_VOTES, N_BINS = 6, 8


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _vote(yes: Column, no: Column | None = None) -> Column:
    v = F.when(yes, F.lit(1))
    return (v if no is None else v.when(no, F.lit(-1))).otherwise(0)


def votes(kind: str, m: Column) -> Column:
    """The six labelers on a candidate (text, before) of a kind."""
    letters = F.length(F.regexp_replace(m.text, "[^A-Za-z]", ""))
    digits = F.length(_digits(m.text))
    strict = m.text.rlike(SOUGHT[kind][2])
    if kind == "secret":
        changes = F.size(F.regexp_extract_all(m.text, F.lit("[A-Za-z][0-9]|[0-9][A-Za-z]"), F.lit(0)))
        mixture = _vote((changes >= 3) & (digits >= 4) & (letters >= 3), (letters == 0) | (digits * 8 < letters))
        typical, context = _vote(strict), _vote(m.before.rlike("[=:]\\s?[\"']?$"), m.before.rlike("[A-Za-z.,]\\s$"))
    else:
        typical, context = _vote(strict, ~strict), _vote(m.before.rlike("[=:]\\s?[\"'<(]?$"))
        mixture = {
            "email": _vote((letters >= 5) & ~m.text.contains(".."), letters < 3),
            "ip": _vote(digits >= 7, digits <= 4),
            "card": _vote(digits.isin(15, 16), digits < 14),
            "phone": _vote(digits.between(10, 13), digits > 14),
            "person": _vote((letters >= 6) & (digits == 0)),
            "address": _vote((letters >= 6) & digits.between(1, 5)),
        }[kind]
    return F.array(
        typical,
        F.when(m.text.rlike(NUMBER), -1).otherwise(0) if kind in ("secret", "address") else F.lit(0),
        _vote(m.before.rlike(rf"(?i)(?<![a-z])({INTRODUCE[kind]})\W{{0,4}}$" if kind != "secret" else rf"(?i)({INTRODUCE[kind]})\W{{0,4}}$")),
        F.when(m.before.rlike(INTRODUCE_NUMBERS), -1).otherwise(0),
        context,
        mixture,
    )


def bins(m: Column) -> Column:
    """Eight features of a candidate, each 0 to 9."""
    share = lambda pattern: F.floor(9 * F.length(F.regexp_replace(m.text, pattern, "")) / F.length(m.text))
    flag = lambda c: F.when(c, 1).otherwise(0)
    return F.array(*[x.cast("int") for x in (
        F.least(F.floor(F.length(m.text) / 8), F.lit(9)), share("[^0-9]"), share("[^a-z]"), share("[^A-Z]"), share("[^a-fA-F0-9]"),
        flag(m.before.rlike("=\\s?[\"']?$")), flag(m.before.rlike("[\"']$")), flag(m.before.rlike("\\w\\W{0,4}$")),
    )])


_SPAN = "array<struct<start:bigint,k:int,end:bigint,votes:array<int>,bins:array<int>>>"


def _candidates(text: Column, kind: str, valid) -> Column:
    needs, pattern, _ = SOUGHT[kind]
    found = F.transform(F.filter(find_all(text, pattern), valid), lambda m: F.struct(
        m.start.alias("start"), F.lit(KINDS.index(kind)).alias("k"), m.end.alias("end"), votes(kind, m).alias("votes"), bins(m).alias("bins"),
    ))
    return F.when(text.contains(needs) if len(needs) == 1 else text.rlike(needs), found).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Candidates by the rules; matches that fail a check are dropped."""
    return F.concat(
        _candidates(text, "email", lambda m: F.lit(True)),
        _candidates(text, "ip", lambda m: m.text.rlike(OCTET)),
        _candidates(text, "card", lambda m: F.length(_digits(m.text)).between(12, 19) & F.call_function("luhn_check", _digits(m.text))),
        _candidates(text, "phone", lambda m: F.length(_digits(m.text)).between(9, 15)),
    )


def further(text: Column, base: Column) -> Column:
    """Candidates of the other kinds that touch no span of the rules."""
    free = lambda m: ~F.exists(base, lambda b: (b.start < m.end) & (m.start < b.end))
    return F.concat(*[_candidates(text, kind, free) for kind in KINDS[N_RULES:]])


def expectation_maximisation(counts: dict[tuple[int, ...], int], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """Probability that candidates with these votes are personal, from votes alone; labelers start as better than chance."""
    rate = {y: [[0.2, 0.5, 0.3] if y == 0 else [0.05, 0.35, 0.6] for _ in range(N_VOTES)] for y in (0, 1)}
    prior, post = 0.5, {}
    for _ in range(rounds):
        for v in counts:
            log = [math.log(1 - prior), math.log(prior)]
            for y in (0, 1):
                log[y] += sum(math.log(rate[y][j][x + 1]) for j, x in enumerate(v))
            post[v] = 1 / (1 + math.exp(min(700, log[0] - log[1])))
        total = sum(counts.values())
        ones = sum(n * post[v] for v, n in counts.items())
        prior = min(0.99, max(0.01, (ones + 1) / (total + 2)))
        for y in (0, 1):
            for j in range(N_VOTES):
                part = [1.0, 1.0, 1.0]
                for v, n in counts.items():
                    part[v[j] + 1] += n * (post[v] if y else 1 - post[v])
                rate[y][j] = [x / sum(part) for x in part]
    return post


def train(found: DataFrame) -> tuple[dict[int, float], dict[tuple[int, int, int], float]]:
    """Log-odds of the final classifier: a constant of each kind, and one for each (kind, feature, value) seen."""
    each = found.select(F.explode("all").alias("c")).select("c.k", "c.votes", "c.bins")
    rows = each.groupBy("k", "votes").agg(F.count("*").alias("n")).collect()
    if not rows:
        return {}, {}
    soft: dict[str, float] = {}
    for k in sorted({r["k"] for r in rows}):
        post = expectation_maximisation({tuple(r["votes"]): r["n"] for r in sorted(rows, key=lambda r: r["votes"]) if r["k"] == k})
        soft |= {f"{k}:{','.join(map(str, v))}": p for v, p in post.items()}
    label = F.create_map(*[F.lit(x) for item in soft.items() for x in item])
    pattern = F.concat_ws(":", F.col("k").cast("string"), F.array_join(F.transform("votes", lambda v: v.cast("string")), ","))
    weighted = each.select("k", "bins", F.element_at(label, pattern).alias("p"))
    sums = weighted.select("k", "p", F.posexplode("bins").alias("feature", "value")).groupBy("k", "feature", "value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    constant, odds = {}, {}
    for k in {r["k"] for r in sums}:
        mine = [r for r in sums if r["k"] == k]
        yes, no = (sum(r[c] for r in mine if r["feature"] == 0) for c in ("yes", "no"))
        constant[k] = math.log((yes + 0.5) / (no + 0.5))
        odds |= {(k, r["feature"], r["value"]): math.log((r["yes"] + 0.5) / (yes + 5)) - math.log((r["no"] + 0.5) / (no + 5)) for r in mine}
    return constant, odds


def find_personal(docs: DataFrame, least: float = 0.9) -> DataFrame:
    """doc_id, base and spans: arrays of struct<start, k (place in KINDS), end, odds (logarithm)>, by start, then kind."""
    base = text_of(docs).withColumn("base", base_spans(F.col("text")))
    found = stage(base.select("doc_id", F.concat("base", further(F.col("text"), F.col("base"))).alias("all")), "personal-data")
    constant, odds = train(found)
    if odds:
        first = F.create_map(*[F.lit(x) for item in constant.items() for x in item])
        table = F.create_map(*[F.lit(x) for (k, j, v), w in odds.items() for x in (k * 100 + j * 10 + v, w)])
        score = lambda c: reduce(lambda a, j: a + F.coalesce(F.element_at(table, c.k * 100 + j * 10 + F.get(c.bins, F.lit(j))), F.lit(0.0)), range(N_BINS), F.element_at(first, c.k))
    else:
        score = lambda c: F.lit(0.0)
    spans = F.array_sort(F.transform("all", lambda c: F.struct(c.start.alias("start"), c.k.alias("k"), c.end.alias("end"), score(c).alias("odds"))))
    scored = found.select("doc_id", spans.alias("all"))
    wanted = lambda s: (s.k < N_RULES) | (s.odds >= math.log(least / (1 - least)))
    return scored.select("doc_id", F.filter("all", lambda s: s.k < N_RULES).alias("base"), F.filter("all", wanted).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.k + 1), s.start.cast("string"), s.end.cast("string"))), ",")


def reported(docs: DataFrame) -> DataFrame:
    """Contract of op10, and the numbers of the further kinds and of all spans."""
    found = find_personal(docs)
    count = lambda k: F.size(F.filter("spans", lambda s: s.k == k)).cast("long").alias(f"n_{KINDS[k]}")
    listed = [F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans")]
    more = [*map(count, range(N_RULES, len(KINDS))), F.size("spans").cast("long").alias("n_spans")]
    return found.select("doc_id", *map(count, range(N_RULES)), *listed, *more)
