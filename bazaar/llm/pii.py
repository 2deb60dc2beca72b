r"""Personal data: regular expressions propose spans, checks confirm them, words nearby adjust their score.

Per kind the leftmost non-overlapping matches of its pattern are proposals; a failing proposal is dropped and not tried
anew further right. Checks: parts of an address, Luhn for cards, mod-97 for IBANs, counts of digits, ranges of
social security numbers. The score starts at the kind's own and rises or falls with the words just before and after the
span. The BASE kinds are kept whatever the words say; the others need THRESHOLD.

Built-in functions only. The patterns are written so that a text is read once: a repetition that nothing follows
is possessive (no recursion, no backtracking), and a match may begin only where an earlier one would not hold too (a
look-behind, or the end of the last match), so a run of a million digits is no quadratic search. A text's proposals
leave as rows with the lengths between them; one exchange by text turns lengths into places.

Defined cases: null text has no span; places count code points from 0, ends are exclusive; rows that share a doc_id and
repeated rows are read each; an empty table gives none. Words nearby reach back to the last match of the same kind at
most. Only doc_id and text are read; other columns pass through `redacted`.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm import common

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]
THRESHOLD = 0.5
BEFORE, AFTER = 48, 16

#: The four base patterns as agreed, in the form described above; the others are this module's own.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # Whole runs of 12 to 19 digits: other runs of the base pattern fail its count of digits anyway.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local_phone": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}",
}
#: A text without this has no match.
NEEDS = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.3}
STEP = 0.3
_PHONE_WORDS = "tel|telephone|phone|call|mobile|cell|fax|whatsapp|telefon|handy|teléfono|móvil|téléphone|portable"
WORDS = {
    "email": "email|e-mail|mail|contact|write to",
    "ip": "ip|host|server|address|login|from",
    "card": "card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte",
    "phone": _PHONE_WORDS,
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security|tax id|taxpayer",
    "local_phone": _PHONE_WORDS,
}
AGAINST = "example|sample|dummy|version|release|order no|invoice|isbn|serial"


def near(words: str) -> str:
    """Pattern of any of the words as whole words, for text in lower case."""
    return f"(^|[^a-z])({words})([^a-z]|$)"


def luhn(digits: Column) -> Column:
    """Whether the check digit of a number fits."""

    def value(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether the check digits of an account number (letters and digits) fit."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code > 57, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed() -> Column:
    """Whether a proposal (kind, match, before, after) passes its kind's check."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    digits = F.regexp_replace(match, "[^0-9]", "")
    part = F.filter(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) > 3)
    low = F.forall(F.split(match, r"\."), lambda p: F.right(F.concat(F.lit("00"), p), F.lit(3)).cast("int") <= 255)
    alone = ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]")
    account = F.replace(match, F.lit(" "), F.lit(""))
    checks = {
        "email": F.lit(True),
        "ip": (F.size(part) == 0) & low,
        "card": luhn(digits),
        "phone": F.length(digits).between(9, 15),
        "iban": alone & F.length(account).between(15, 34) & mod97(account),
        "ssn": ~before.rlike("[0-9-]$") & ~after.rlike("^[0-9-]") & ~match.rlike("^(000|666|9)|-00-|-0000$"),
        "local_phone": ~before.rlike(r"[0-9+-]$|\+[0-9][ ().0-9-]*$") & ~after.rlike("^[0-9-]"),
    }
    return reduce(lambda no, k: F.when(F.col("kind") == KINDS.index(k), checks[k]).otherwise(no), KINDS, F.lit(False))


def score() -> Column:
    """0 to 1: the kind's own, more with words that go with it, less with words that speak against it."""
    around = F.translate(F.concat("before", F.lit(" "), "after"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = reduce(lambda no, k: F.when(F.col("kind") == KINDS.index(k), F.lit(SCORES[k]) + F.when(around.rlike(near(WORDS[k])), STEP).otherwise(0)).otherwise(no), KINDS, F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), own - F.when(around.rlike(near(AGAINST)), STEP).otherwise(0)))


def _proposed(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """One row per proposal, and one for a text without any: row, kind, i, gap, match, before, after."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *keep, F.coalesce("text", F.lit("")).alias("text"))
    kept = [c for c in rows.columns if c != "text"]
    for k, pattern in PATTERNS.items():
        has = F.col("text").contains(NEEDS[k]) & F.col("text").rlike(pattern) if k in NEEDS else F.col("text").rlike(pattern)
        rows = rows.withColumn(f"{k}_in", F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
        rows = rows.withColumn(f"{k}_gaps", F.when(F.col(f"{k}_in").isNotNull(), F.split("text", pattern, -1)))

    def listed(kind: str) -> Column:
        gaps = F.col(f"{kind}_gaps")
        each = lambda m, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), m.alias("match"), F.length(gaps[i]).alias("gap"),
            F.right(gaps[i], F.lit(BEFORE)).alias("before"), F.left(gaps[i + 1], F.lit(AFTER)).alias("after"),
        )
        return F.transform(f"{kind}_in", each)

    every = F.concat(*[F.coalesce(listed(k), F.array()) for k in KINDS])
    return rows.select(*kept, F.posexplode_outer(every).alias("nth", "p")).select(*kept, "nth", "p.*")


def located(docs: DataFrame, *keep: Column) -> DataFrame:
    """Every proposal's row with its place, check and score; texts without one have a row without kind."""
    rows = _proposed(docs, list(keep)).repartition("row")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
    rows = rows.withColumn("start", F.col("end") - F.length("match")).withColumn("base", F.col("kind") < len(BASE))
    rows = rows.withColumn("confirmed", F.coalesce(confirmed(), F.lit(False))).withColumn("score", F.when(F.col("confirmed"), score()))
    return rows.withColumn("kept", F.col("confirmed") & (F.col("base") | (F.col("score") >= THRESHOLD)))


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, kind, start, end, score of every span that stays."""
    rows = located(docs, F.col("doc_id").cast("long")).filter("kept")
    return rows.select("doc_id", _name(F.col("kind")).alias("kind"), "start", "end", "score")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the hash of their spans, and all spans."""
    rows = located(docs, F.col("doc_id").cast("long"))
    here = F.when(F.col("kept"), F.struct("start", "kind", "end", "base"))
    counts = [F.count_if(F.col("kept") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(BASE)]
    per = rows.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *counts, F.sort_array(F.collect_list(here)).alias("found"))
    text = lambda s: F.concat_ws(":", _name(s["kind"]), s["start"], s["end"])
    joined = lambda found: F.array_join(F.transform(found, text), ",")
    base = joined(F.filter("found", lambda s: s["base"]))
    return per.select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns; each span is replaced by its kind in brackets."""
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole")
    rows = located(docs, whole)
    # The document travels with the first of its rows only; a span that begins within an earlier one goes with it.
    rows = rows.withColumn("whole", F.when(F.coalesce("nth", F.lit(0)) == 0, F.col("whole")))
    earlier = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("upto", F.coalesce(F.max(F.when(F.col("kept"), F.col("end"))).over(earlier), F.lit(0)))
    here = F.when(F.col("kept") & (F.col("end") > F.col("upto")), F.struct(F.greatest("start", "upto").alias("start"), "end", "kind"))
    per = rows.groupBy("row").agg(F.first("whole", ignorenulls=True).alias("whole"), F.sort_array(F.collect_list(here)).alias("found"))
    text, found = F.col("whole.text"), F.col("found")
    upto = lambda i: F.when(i > 0, found[i - 1]["end"]).otherwise(0)
    piece = lambda s, i: F.concat(F.substr(text, (upto(i) + 1).cast("int"), (s["start"] - upto(i)).cast("int")), F.lit("["), F.upper(_name(s["kind"])), F.lit("]"))
    rest = F.substr(text, (F.element_at(found, -1)["end"] + 1).cast("int"))
    changed = F.when(F.size(found) > 0, F.concat(F.array_join(F.transform(found, piece), ""), rest)).otherwise(text)
    out = per.select("whole", changed.alias("changed"))
    columns = [F.col("changed").alias(c) if c == "text" else F.col(f"whole.`{c}`").alias(c) for c in names]
    return out.select(*columns)
