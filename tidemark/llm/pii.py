"""Personal data by weak supervision, in DataFrame functions alone.

Patterns propose spans. Labelers of three sorts (stricter patterns, gazetteers, words nearby) vote for, against or
not at all; expectation-maximisation over the counts of vote combinations estimates how reliable each labeler is, and
a logistic span classifier is trained on the resulting posteriors. Base spans stay whatever the classifier says; of
the further proposals those it accepts are reported.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_workdir

# The base patterns. A run is entered at its start, or where the match before it ended, and never given
# back, which finds the same matches in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
# Further proposals.
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?<!\+[0-9]{1,3}[\x20.-]{0,2})(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])"
PERSON = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30})?"
# Gazetteers.
DOMAIN_ENDS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
GIVEN_NAMES = ("James", "Mary", "John", "Anna", "Peter", "Maria", "Paul", "Laura", "Hans", "Claire", "Juan", "Carmen", "Pierre", "Julia")
AREAS_NEVER_GIVEN = ("000", "666")
IBAN_LENGTHS = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "BE": 16, "AT": 20, "CH": 21}
# Words nearby, within so many characters before a span.
NEARBY = 40
FOR = {
    "email": r"\b(?:e-?mail|mail|contact|write|courriel|correo)\b", "ip": r"\b(?:ip|host|address|server|login)\b",
    "card": r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b", "phone": r"\b(?:phone|tel|call|mobile|fax|telefon|t[eé]l[eé]phone)\b",
    "ssn": r"\b(?:ssn|social security)\b", "iban": r"\b(?:iban|account|konto|compte|cuenta)\b",
    "local_phone": r"\b(?:phone|tel|call|mobile|fax)\b", "person": r"\b(?:dear|name|contact|by|signed)\b",
}
AGAINST = r"(?:\b(?:version|release|section|chapter|part no|isbn|order|ticket|build)\W*|[#$€£=/]\s*)$"


@dataclass(frozen=True)
class Settings:
    """``accept`` is the least score of a further proposal; steps are those of the two fits, over vote combinations."""

    accept: float = 0.5
    em_steps: int = 25
    fit_steps: int = 200
    rate: float = 0.5


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _small(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))


def _mod_97(hit: Column) -> Column:
    plain = F.regexp_replace(hit, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.when(value(c) > 9, a * 100 + value(c)).otherwise(a * 10 + value(c)) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


# Pattern, what a text must hold for the pattern to be tried, and the check that a match must pass to be proposed.
PROPOSED = {
    "email": (EMAIL, lambda t: F.contains(t, F.lit("@")), lambda h: F.lit(True)),
    "ip": (IP, lambda t: t.rlike("[0-9]"), lambda h: F.forall(F.split(h, r"\."), _small)),
    "card": (CARD, lambda t: t.rlike("[0-9]"), lambda h: F.length(_digits(h)).between(13, 19) & _luhn(_digits(h))),
    "phone": (PHONE, lambda t: F.contains(t, F.lit("+")), lambda h: F.length(_digits(h)).between(9, 15)),
    "ssn": (SSN, lambda t: t.rlike("[0-9]"), lambda h: F.lit(True)),
    "iban": (IBAN, lambda t: t.rlike("[0-9]"), lambda h: F.lit(True)),
    "local_phone": (LOCAL_PHONE, lambda t: t.rlike("[0-9]"), lambda h: F.lit(True)),
    "person": (PERSON, lambda t: t.rlike("(?:Mr|Mrs|Ms|Dr|Prof)"), lambda h: F.lit(True)),
}
LABELERS = ("pattern", "gazetteer", "nearby", "against")


def _votes(kind: str, hit: Column, before: Column) -> list[Column]:
    """One vote for each labeler: 1 for, 0 against, null for none."""
    yes = lambda c: F.when(c, F.lit(1.0))
    strict = {
        "email": hit.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@.{1,250}\.[A-Za-z]{2,24}$"), "ip": ~hit.rlike(r"(^|\.)0[0-9]"),
        "card": hit.rlike("^[3-6]"), "phone": ~hit.rlike(r"[\x20().-]{3}"),
        "ssn": ~hit.rlike(r"^9|-00-|-0000$"), "iban": _mod_97(hit), "local_phone": ~hit.rlike(r"^\(?[01]"), "person": hit.rlike(r" [A-Z][a-z]+ [A-Z]"),
    }[kind]
    country = F.substr(hit, F.lit(1), F.lit(2))
    lengths = F.coalesce(*[F.when(country == c, F.lit(n)) for c, n in IBAN_LENGTHS.items()])
    listed = {
        "email": yes(F.lower(F.substring_index(hit, ".", -1)).isin(*DOMAIN_ENDS)), "ip": F.when(hit.rlike(r"^(?:0|127|255)\."), F.lit(0.0)),
        "card": F.when(_digits(hit).rlike(r"^(.)\1+$"), F.lit(0.0)), "phone": F.lit(None).cast("double"),
        "ssn": F.when(F.substr(hit, F.lit(1), F.lit(3)).isin(*AREAS_NEVER_GIVEN), F.lit(0.0)),
        "iban": F.when(lengths.isNotNull(), (F.length(F.regexp_replace(hit, " ", "")) == lengths).cast("double")),
        "local_phone": F.lit(None).cast("double"), "person": yes(F.exists(F.split(hit, " "), lambda w: w.isin(*GIVEN_NAMES))),
    }[kind]
    return [F.when(strict, F.lit(1.0)).otherwise(F.lit(0.0)), listed, yes(before.rlike(FOR[kind])), F.when(before.rlike(AGAINST), F.lit(0.0))]


# Running sums are taken over blocks of this many widths, so that a text of n matches costs n times a constant.
BLOCK = 128


def _spans(texts: DataFrame) -> DataFrame:
    """``texts`` (id, text) to (id, and one array of proposed spans for each kind, by start).

    A split gives what lies between matches; running sums of its lengths and those of the matches are their places.
    """
    df = texts
    none = F.expr("cast(array() AS array<string>)")
    names = list(PROPOSED)
    df = df.select("id", "text", *(needs(F.col("text")).alias(f"try_{k}") for k, (_, needs, _) in PROPOSED.items()))
    found = []
    for k, (pattern, _, _) in PROPOSED.items():
        found += [F.when(F.col(f"try_{k}"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none).alias(f"hits_{k}"),
                  F.when(F.col(f"try_{k}"), F.split("text", pattern, -1)).otherwise(none).alias(f"gaps_{k}")]
    df = df.select("id", *found)
    item = lambda h, g: F.struct(h.alias("hit"), F.lower(F.right(g, F.lit(NEARBY))).alias("before"), (F.length(g) + F.length(h)).cast("long").alias("width"))
    df = df.select("id", *(F.zip_with(f"hits_{k}", F.slice(f"gaps_{k}", 1, F.size(f"hits_{k}")), item).alias(k) for k in names))
    zero, add = F.lit(0).cast("long"), lambda a, x: a + x
    df = df.withColumns({f"w_{k}": F.col(f"{k}.width") for k in names})
    block = lambda k, c, n: F.slice(f"w_{k}", c * BLOCK + 1, n)

    def block_sums(k: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.expr(f"cast((size(w_{k}) - 1) div {BLOCK} AS int)")),
                           lambda c: F.aggregate(block(k, c, F.lit(BLOCK)), zero, add))

    def sums_before(k: str) -> Column:
        return F.transform(f"sum_{k}", lambda _, c: F.aggregate(F.slice(f"sum_{k}", F.lit(1), c), zero, add))

    df = df.withColumns({f"sum_{k}": block_sums(k) for k in names})
    df = df.withColumns({f"upto_{k}": sums_before(k) for k in names})

    def place(k: str) -> Column:
        def one(x: Column, i: Column) -> Column:
            c = F.floor(i / BLOCK).cast("int")
            end = F.get(F.col(f"upto_{k}"), c) + F.aggregate(block(k, c, i - c * BLOCK + 1), zero, add)
            return F.struct(F.lit(k).alias("kind"), (end - F.length(x.hit)).alias("start"), end.alias("end"), x.hit.alias("hit"), x.before.alias("before"))
        return F.transform(k, one)

    df = df.select("id", *(place(k).alias(k) for k in names))

    def passed(k: str) -> Column:
        return F.filter(k, lambda s: PROPOSED[k][2](s.hit))

    def voted(k: str) -> Column:
        return F.transform(k, lambda s: F.struct(s.kind, s.start, s.end, F.array(*_votes(k, s.hit, s.before)).alias("votes")))

    return df.select("id", *(passed(k).alias(k) for k in names)).select("id", *(voted(k).alias(k) for k in names))


def reliabilities(spans: DataFrame, settings: Settings) -> DataFrame:
    """One row: ``p`` (prior, and each labeler's rate of yes on true and on false spans) and ``w``, the classifier's weights, bias first.

    The combinations number three to the number of labelers at most, whatever the data; both fits are folds over
    their steps.
    """
    m = len(LABELERS)
    seen = F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n"))))
    at = lambda a, i: F.get(a, F.lit(i))

    def posterior(v: Column, p: Column) -> Column:
        yes, no = at(p, 0), 1 - at(p, 0)
        for i in range(m):
            hit, false = at(p, 1 + i), at(p, 1 + m + i)
            yes = yes * F.when(at(v, i).isNull(), F.lit(1.0)).when(at(v, i) == 1, hit).otherwise(1 - hit)
            no = no * F.when(at(v, i).isNull(), F.lit(1.0)).when(at(v, i) == 1, false).otherwise(1 - false)
        return yes / (yes + no)

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda a, x: a + value(x))

    def em(p: Column, _: Column) -> Column:
        judged = F.transform("seen", lambda x: F.struct(x.votes, x.n, posterior(x.votes, p).alias("q")))
        # One vote is added on either side, so that no reliability becomes certain.
        share = lambda q, i: (total(judged, lambda x: F.when(at(x.votes, i) == 1, x.n * q(x)).otherwise(0.0)) + 1) / (
            total(judged, lambda x: F.when(at(x.votes, i).isNotNull(), x.n * q(x)).otherwise(0.0)) + 2)
        prior = (total(judged, lambda x: x.n * x.q) + 1) / (total(judged, lambda x: x.n) + 2)
        return F.array(prior, *(share(lambda x: x.q, i) for i in range(m)), *(share(lambda x: 1 - x.q, i) for i in range(m)))

    start = F.array(F.lit(0.7), *[F.lit(0.8)] * m, *[F.lit(0.3)] * m)
    fold = lambda steps, first, one: F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, one)

    def margin(v: Column, w: Column) -> Column:
        out = at(w, 0)
        for i in range(m):
            out = out + at(w, 1 + i) * F.when(at(v, i) == 1, F.lit(1.0)).when(at(v, i) == 0, F.lit(-1.0)).otherwise(0.0)
        return out

    def descend(w: Column, _: Column) -> Column:
        judged = F.transform("soft", lambda x: F.struct(x.votes, (x.n * (1 / (1 + F.exp(-margin(x.votes, w))) - x.q)).alias("g")))
        size = F.greatest(F.lit(1.0), total(F.col("soft"), lambda x: x.n))
        step = lambda i: total(judged, lambda x: x.g * F.when(at(x.votes, i) == 1, F.lit(1.0)).when(at(x.votes, i) == 0, F.lit(-1.0)).otherwise(0.0))
        return F.array(at(w, 0) - settings.rate * total(judged, lambda x: x.g) / size, *(at(w, 1 + i) - settings.rate * step(i) / size for i in range(m)))

    counted = spans.groupBy("votes").agg(F.count("*").alias("n")).agg(seen.alias("seen"))
    learned = counted.withColumn("p", fold(settings.em_steps, start, em))
    soft = learned.withColumn("soft", F.transform("seen", lambda x: F.struct(x.votes, x.n, posterior(x.votes, F.col("p")).alias("q"))))
    return soft.select("p", fold(settings.fit_steps, F.array(*[F.lit(0.0)] * (m + 1)), descend).alias("w"))


def find_pii(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, an array of (kind, start, end, score) in code points, end exclusive.

    Base kinds are ``email``, ``ip``, ``card`` and ``phone``; they come first, in that order, each by start, and are always
    reported. ``ssn``, ``iban``, ``local_phone`` and ``person`` follow where the classifier accepts them. A null or empty
    text has no spans; repeated rows give repeated rows, an empty table none. Other columns are not read.

    Texts are read once and not shuffled: proposals are written with their votes, the votes counted, and the proposals
    scored. What reaches the driver are the five weights.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    path = new_workdir(spark, "pii")
    proposed = _spans(texts)
    proposed.write.parquet(path)
    proposed = spark.read.schema(proposed.schema).parquet(path)
    names = list(PROPOSED)
    votes = proposed.select(F.explode(F.concat(*names)).alias("s")).select("s.votes")
    w = reliabilities(votes, settings).first().w

    def score(v: Column) -> Column:
        out = F.lit(float(w[0]))
        for i in range(len(LABELERS)):
            out = out + float(w[1 + i]) * F.when(F.get(v, F.lit(i)) == 1, F.lit(1.0)).when(F.get(v, F.lit(i)) == 0, F.lit(-1.0)).otherwise(0.0)
        return 1 / (1 + F.exp(-out))

    judged = F.transform(F.concat(*names), lambda s: F.struct(s.kind, s.start, s.end, score(s.votes).alias("score")))
    kept = F.filter(judged, lambda s: s.kind.isin(*BASE) | (s.score >= settings.accept))
    return proposed.select(F.col("id").alias(id_column), kept.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as one text."""
    written = lambda column: F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
