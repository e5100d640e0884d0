"""Personal data by weak supervision, in DataFrame functions alone: regular expressions, gazetteers and contexts vote on
candidate spans, expectation-maximisation estimates how reliable they are, and its labels train a span classifier."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import quoted, text_of, whole_row
from navloom.llm.spans import listed, spans_of
from navloom.session import cut_lineage

# Every pattern takes time in proportion to the text: no group is repeated, and a run is entered at its start alone.
LOCAL = r"A-Za-z0-9._%+\x{E000}-"
#: A dot that no label follows cannot be part of a domain; as this character it can still be part of a name.
SOFT_DOT, OTHER = "\ue000", "\ue001"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = "(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0++)"
CARD = r"[0-9][0-9\x20-]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?<![0-9+().-]|[0-9)]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])"
PERSON = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30})?(?![a-z])"

# Usual endings, prefixes and words near personal data.
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at", "ca", "au", "us", "in", "jp", "br")
COUNTRY_CODES = ("1", "33", "34", "39", "41", "43", "44", "49", "31", "32", "45", "46", "47", "48", "61", "81", "86", "91", "55", "52", "7")
NAMES = ("anna", "carlos", "david", "elena", "emma", "george", "hans", "james", "jane", "jean", "john", "jose", "juan", "julia", "karl", "laura", "linda", "luis", "maria", "marie", "mary", "michael", "paul", "peter", "pierre", "robert", "sarah", "smith", "susan", "thomas", "william")
IBAN_COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: how to find it, what makes a match count, and the labelers' tests of a span."""

    name: str
    base: bool
    find: Callable[[Column], Column]
    regex: Callable[[Column], Column]  # strict form
    gazetteer: Callable[[Column], Column]  # known parts
    words: str  # of the context before a span


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _emails(text: Column) -> Column:
    soft = F.regexp_replace(F.translate(text, SOFT_DOT, OTHER), r"\.(?![A-Za-z0-9-])", SOFT_DOT)
    return spans_of(soft, EMAIL, text.contains("@"))


def _ips(text: Column) -> Column:
    return F.filter(spans_of(text, IP), lambda s: s["hit"].rlike(rf"^{IP_PART}\.{IP_PART}\.{IP_PART}\.{IP_PART}$"))


def _cards(text: Column) -> Column:
    """A separator that is not between two digits ends a number; it gives way to a character that is in none."""
    runs = F.regexp_replace(text, r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", OTHER)
    found = spans_of(runs, CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"))
    return F.filter(found, lambda s: F.length(_digits(s["hit"])).between(14, 19) & F.call_function("luhn_check", _digits(s["hit"])))


def _phones(text: Column) -> Column:
    return F.filter(spans_of(text, PHONE), lambda s: F.length(_digits(s["hit"])).between(10, 15))


def _within(values: tuple[str, ...], part: Column) -> Column:
    return part.isin(*values)


KINDS = (
    Kind("email", True, _emails, lambda h: h.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"), lambda h: _within(DOMAINS, F.lower(F.regexp_extract(h, r"\.([^.]+)$", 1))), "mail|contact|write|reach|kontakt|correo|courriel"),
    Kind("ip", True, _ips, lambda h: ~h.rlike(r"(?:^|\.)0[0-9]"), lambda h: ~h.rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\."), r"\bip\b|server|host|address|login|client"),
    Kind("card", True, _cards, lambda h: F.length(_digits(h)).between(15, 16), lambda h: _digits(h).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"), "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", True, _phones, lambda h: h.rlike(r"^\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9])[\x20.0-9-]+$"), lambda h: F.regexp_extract(h, r"^\+([0-9]{1,2})", 1).isin(*COUNTRY_CODES) | F.substring(h, 2, 1).isin("1", "7"), "call|phone|tel|fax|mobile|cell"),
    Kind("ssn", False, lambda t: spans_of(t, SSN, t.contains("-")), lambda h: ~h.rlike("^(?:000|666|9)|-00-|-0000$"), lambda h: F.substring(h, 1, 3).between("001", "772"), "ssn|social|security"),
    Kind("iban", False, lambda t: spans_of(t, IBAN), lambda h: F.length(h).between(15, 34), lambda h: _within(IBAN_COUNTRIES, F.substring(h, 1, 2)), "iban|bank|account|konto|cuenta|compte"),
    Kind("local_phone", False, lambda t: spans_of(t, LOCAL_PHONE), lambda h: _digits(h).rlike("^[2-9][0-9]{2}[2-9]"), lambda h: F.lit(None).cast("boolean"), "call|phone|tel|fax|mobile|cell"),
    Kind("person", False, lambda t: spans_of(t, PERSON), lambda h: h.rlike(r"\x20[A-Z][a-z]+\x20[A-Z][a-z]+$"), lambda h: F.exists(F.split(F.lower(h), r"[\x20.]+"), lambda w: w.isin(*NAMES)), "dear|name|sincerely|regards|signed|by"),
)
VOTES, TRAITS = 5, 4
#: Code points before a span that its context labeler reads.
CONTEXT = 40
CANDIDATE = "array<struct<start:int,place:int,end:int,kind:string,base:boolean,votes:array<int>,traits:array<int>>>"


def _vote(test: Column) -> Column:
    """1 for, 0 against, -1 no opinion."""
    return F.coalesce(test.cast("int"), F.lit(-1))


def _judged(text: Column, kind: Kind, place: int) -> Column:
    def judge(span: Column) -> Column:
        hit = span["hit"]
        before = F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT)))
        after = F.substring(text, span["end"] + 1, F.lit(1))
        near, digits = F.lower(before), _digits(hit)
        joined = before.rlike(r"[A-Za-z0-9_/=-]$") | after.rlike("^[A-Za-z0-9_/=]")
        flat = (F.length(digits) >= 6) & (F.length(F.array_join(F.array_distinct(F.split(digits, "")), "")) <= 2)
        votes = F.array(
            _vote(kind.regex(hit)),
            _vote(kind.gazetteer(hit)),
            _vote(F.when(near.rlike(kind.words), F.lit(True))),
            _vote(F.when(joined, F.lit(False))),
            _vote(F.when(flat, F.lit(False))),
        )
        traits = F.array(before.rlike(r"(?:^|[\x20\n(<:])$").cast("int"), after.rlike(r"^(?:$|[\x20\n.,;)>])").cast("int"), (F.length(hit) >= 12).cast("int"), near.rlike(r"[:=]\x20*$").cast("int"))
        return F.struct(span["start"].alias("start"), F.lit(place).alias("place"), span["end"].alias("end"), F.lit(kind.name).alias("kind"), F.lit(kind.base).alias("base"), votes.alias("votes"), traits.alias("traits"))

    return F.transform(kind.find(text), judge)


def candidate_spans(text: Column) -> Column:
    return F.concat(F.array().cast(CANDIDATE), *[_judged(text, kind, place) for place, kind in enumerate(KINDS)])


def _reliabilities(patterns: Column, steps: int = 60) -> Column:
    """Expectation-maximisation over the vote patterns of one kind: the posterior of each pattern.

    Labelers are independent given the truth; each has a rate of votes for, among true and among false spans, with Beta(8, 2)
    and Beta(2, 8) priors, and abstains at the same rate in both.
    """
    vote = lambda p, j: F.get(p["votes"], F.lit(j))
    start = F.struct(
        F.transform(patterns, lambda p: F.lit(0.5)).alias("w"), F.lit(0.5).alias("prior"), F.array(*[F.lit(0.8)] * VOTES).alias("hit"), F.array(*[F.lit(0.2)] * VOTES).alias("slip"),
    )

    def posterior(p: Column, acc: Column) -> Column:
        odds = F.log(acc["prior"]) - F.log(1 - acc["prior"])
        for j in range(VOTES):
            hit, slip = F.get(acc["hit"], F.lit(j)), F.get(acc["slip"], F.lit(j))
            odds = odds + F.when(vote(p, j) == 1, F.log(hit / slip)).when(vote(p, j) == 0, F.log((1 - hit) / (1 - slip))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))

    def step(acc: Column, _: Column) -> Column:
        pairs = F.zip_with(patterns, acc["w"], lambda p, w: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), w.alias("w")))
        add = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, x: s + f(x))
        yes, no = (lambda x: x["n"] * x["w"]), (lambda x: x["n"] * (1 - x["w"]))

        def rate(weight: Callable[[Column], Column], j: int, a: float, b: float) -> Column:
            return (add(lambda x: F.when(vote(x, j) == 1, weight(x)).otherwise(0.0)) + a) / (add(lambda x: F.when(vote(x, j) >= 0, weight(x)).otherwise(0.0)) + a + b)

        return F.struct(
            F.transform(patterns, lambda p: posterior(p, acc)).alias("w"),
            ((add(yes) + 1) / (add(lambda x: x["n"]) + 2)).alias("prior"),
            F.array(*[rate(yes, j, 8.0, 2.0) for j in range(VOTES)]).alias("hit"),
            F.array(*[rate(no, j, 2.0, 8.0) for j in range(VOTES)]).alias("slip"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda acc: acc["w"])


def train_classifier(candidates: DataFrame) -> DataFrame:
    """By kind: ``bias`` and ``weights`` of a linear classifier of votes and traits, trained on the labels of the
    expectation-maximisation.  Candidates enter as counts of their patterns, at most 3^5 * 2^4 a kind."""
    patterns = cut_lineage(candidates.groupBy("kind", "votes", "traits").agg(F.count(F.lit(1)).cast("double").alias("n")))
    by_votes = patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")).groupBy("kind").agg(F.collect_list(F.struct("votes", "n")).alias("patterns"))
    labels = by_votes.select("kind", F.explode(F.arrays_zip("patterns", _reliabilities(F.col("patterns")).alias("w"))).alias("p"))
    labels = labels.select("kind", F.col("p.patterns.votes").alias("votes"), F.col("p.w").alias("w"))
    soft = patterns.join(labels, ["kind", "votes"])
    flags = [(F.get("votes", F.lit(j)) == v).cast("double") for j in range(VOTES) for v in (0, 1)] + [F.get("traits", F.lit(j)).cast("double") for j in range(TRAITS)]
    true, false = F.col("n") * F.col("w"), F.col("n") * (1 - F.col("w"))
    sums = soft.groupBy("kind").agg(F.sum(true).alias("true"), F.sum(false).alias("false"), *[F.sum(true * f).alias(f"t{k}") for k, f in enumerate(flags)], *[F.sum(false * f).alias(f"f{k}") for k, f in enumerate(flags)])
    weights = [F.log((F.col(f"t{k}") + 1) / (F.col("true") + 2)) - F.log((F.col(f"f{k}") + 1) / (F.col("false") + 2)) for k in range(len(flags))]
    return sums.select("kind", F.log((F.col("true") + 1) / (F.col("false") + 1)).alias("bias"), F.array(*weights).alias("weights"))


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per input row: ``row``, an array of (start, place, end, kind) for each base kind (``email``, ``ip``, ``card``,
    ``phone``), and ``more`` with the spans of the other kinds that the classifier accepts.

    Base spans follow from their patterns; their candidates vote and train with all others.  The classifier has one row a
    kind, which bounds what is broadcast.  Positions are code points, ends are exclusive.

    Null or empty text: no spans.  Repeated rows get the same spans and count again in the statistics.  Empty table: no
    rows.  Other columns travel in ``row``.
    """
    rows = docs.select(whole_row(docs), candidate_spans(text_of(text_col)).alias("spans"))
    classifier = train_classifier(rows.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.traits"))
    model = {r.kind: (r.bias, r.weights) for r in classifier.collect()}

    def accepted(span: Column) -> Column:
        fine = F.lit(False)
        for kind in KINDS:
            if kind.base or kind.name not in model:
                continue
            bias, weights = model[kind.name]
            score = F.lit(float(bias))
            for k, weight in enumerate(weights):
                flag = (F.get(span["votes"], F.lit(k // 2)) == k % 2) if k < 2 * VOTES else (F.get(span["traits"], F.lit(k - 2 * VOTES)) == 1)
                score = score + F.when(flag, float(weight)).otherwise(0.0)
            fine = F.when(span["kind"] == kind.name, score >= 0).otherwise(fine)
        return fine

    plain = lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))
    of = lambda name: F.filter("spans", lambda s: s["kind"] == name)
    base = [F.transform(of(k.name), plain).alias(k.name) for k in KINDS if k.base]
    return rows.select("row", *base, F.transform(F.filter("spans", lambda s: ~s["base"] & accepted(s)), plain).alias("more"))


def summary() -> list[Column]:
    """Counts of the base kinds, the hash of their list, and the list of all spans."""
    names = [k.name for k in KINDS if k.base]
    base = F.concat(*[F.col(n) for n in names])
    return [*[F.size(n).cast("long").alias(f"n_{n}") for n in names], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.concat(base, F.col("more"))).alias("spans")]
