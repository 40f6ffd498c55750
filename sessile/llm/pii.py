"""Personal data and secrets in texts, in SQL expressions only.

Regular expressions propose spans, checksums and alphabets confirm them (Luhn
for cards, mod 97 for IBANs, octet ranges for addresses, digit counts for
phones, mixed characters for secrets), and words around a span, before and
after it, raise or lower its score.

Spark has no function for the positions of all matches, but the pieces that
``split`` leaves and the matches that ``regexp_extract_all`` finds alternate, so
positions are sums of their lengths.  These sums double their reach in every
round (a prefix sum in log n rounds), so a text of n matches takes n log n
steps.

The patterns are those of the contract, made linear: a run is entered at its
start only (or where the last match ended, ``\\G``) and repeated groups are
possessive.  In each of them what follows a repetition can't begin with what
it repeats, so neither changes what matches; but runs of any length are
scanned once and without recursion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """A kind of span: pattern, words around it that raise and lower its score, score without them, whether it stays
    at any score."""

    name: str
    pattern: str
    context: str
    against: str
    score: float
    base: bool = True


#: Base kinds in their order, then the kinds that checksums and context add.
KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "mail|e-mail|contact|write to", "example|placeholder", 0.9),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "ip|host|server|address|login", "version|release|chapter|section", 0.7),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "cards?|visa|credit|payment|amex|mastercard|carte|tarjeta", "order|invoice|serial|tracking|isbn|sku", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "phones?|tel|call|fax|mobile|whatsapp", "order|invoice|serial|isbn", 0.7),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", "iban|account|bank|transfer", "serial|part", 0.8, False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "ssns?|social security|tax id|taxpayer", "order|invoice|serial|part", 0.3, False),
    Kind("secret", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}+", "tokens?|secrets?|passwords?|passwd|pwd|api.?key|access.?key|private.?key|auth|bearer|credentials?", "commit|sha1|sha256|md5|hash|checksum|digest|uuid|isbn", 0.3, False),
]
#: Characters before and after a span that are searched for words that raise its score, characters before it for those
#: that call it something else; what a word adds or takes; the least score of an added span.
WINDOW, NAMED, BONUS, THRESHOLD = 40, 20, 0.3, 0.5
#: Matches on either side that are looked at for the window: each takes three characters at least.
_NEAR = WINDOW // 3 + 1


def _valid(kind: Kind, span: Column) -> Column:
    digits = F.regexp_replace(span, "[^0-9]", "")
    if kind.name == "ip":
        return F.forall(F.split(span, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind.name == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind.name == "phone":
        return F.length(digits).between(9, 15)
    if kind.name == "iban":
        compact = F.regexp_replace(span, " ", "")
        codes = F.split(F.concat(F.substring(compact, 5, 34), F.substring(compact, 1, 4)), "")
        # A letter stands for two digits, A = 10 to Z = 35.
        rest = F.aggregate(
            F.filter(codes, lambda c: c != ""),
            F.lit(0),
            lambda acc, c: F.when(c <= "9", (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
        )
        return F.length(compact).between(15, 34) & (rest == 1)
    if kind.name == "ssn":
        return ~span.rlike("^(000|666|9)|-00-|-0000$")
    if kind.name == "secret":
        # Letters and digits in turn, of many kinds; no path and no word with a number at its end.
        varied = F.size(F.array_distinct(F.split(span, ""))) >= 9
        return (F.length(digits) >= 4) & span.rlike("[A-Za-z]") & span.rlike("[0-9][^0-9]+[0-9][^0-9]*[0-9]") & ~span.rlike("/.*/.*/|--|__") & varied
    return F.lit(True)


def _prefix_sums(sizes: Column) -> Column:
    """Sums of an array of numbers up to each place, itself included, in as many rounds as its length has bits."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(sizes), F.lit(1)).cast("double"))).cast("int"))
    return F.aggregate(rounds, sizes, lambda acc, k: F.transform(acc, lambda v, i: v + F.when(i >= F.pow(F.lit(2.0), k), F.get(acc, (i - F.pow(F.lit(2.0), k)).cast("int"))).otherwise(0)))


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _pieces(kind: Kind, text: Column) -> Column:
    """``gaps`` between the matches of a kind and the matches ``found``; a text starts and ends with a gap."""
    return F.struct(F.split(text, kind.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"))


def _confirmed(kind: Kind, p: Column) -> Column:
    """For each match (start, end, score), or null where it isn't valid or scores too little."""
    gaps, found = p["gaps"], p["found"]

    def around(first: Column, n: Column) -> Column:
        """Text of n matches, each with the gap before it, and of the gap after them."""
        return F.array_join(F.transform(F.sequence(first, first + n), lambda j: F.concat(F.get(gaps, j), F.when(j < first + n, F.get(found, j)).otherwise(F.lit("")))), "")

    def score(i: Column) -> Column:
        start = F.greatest(F.lit(0), i - _NEAR)
        before, after = around(start, i - start), around(i + 1, F.least(F.lit(_NEAR), F.size(found) - i - 1))
        near = F.lower(F.concat(F.right(before, F.lit(WINDOW)), F.lit(" | "), F.left(after, F.lit(WINDOW))))
        name = F.lower(F.right(before, F.lit(NAMED)))
        moved = F.when(near.rlike(rf"\b(?:{kind.context})\b"), BONUS).otherwise(0.0) - F.when(name.rlike(rf"\b(?:{kind.against})\b"), BONUS).otherwise(0.0)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), kind.score + moved))

    def row(end: Column, i: Column) -> Column:
        out = F.when(_valid(kind, F.get(found, i)), F.struct((end - F.length(F.get(found, i))).alias("start"), end.alias("end"), score(i).alias("score")))
        return out if kind.base else _once(out, lambda s: F.when(s["score"] >= THRESHOLD, s))

    return F.transform(_prefix_sums(F.transform(found, lambda hit, i: F.length(F.get(gaps, i)) + F.length(hit))), row)


def _spans(kind: Kind, text: Column) -> Column:
    """Array of (start, end, score) of the confirmed spans of a kind, by start."""
    return F.filter(_once(_pieces(kind, text), lambda p: _confirmed(kind, p)), lambda s: s.isNotNull())


#: What any match of a kind holds; other texts are not searched.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "ssn": "-[0-9]{2}-", "secret": "[A-Za-z0-9+/_-]{20}"}


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` and, for every kind, its spans: array of (start, end, score).

    Starts and ends count code points of the whole text, ends exclusive.  A
    null text is empty; rows that repeat an id give a row each; a null id stays
    null; an empty table gives no rows.  Columns but doc_id and text are left
    out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.expr("cast(array() as array<struct<start:int,end:int,score:double>>)")
    return docs.select("doc_id", *[F.when(text.rlike(_NEEDS[k.name]), _spans(k, text)).otherwise(none).alias(k.name) for k in KINDS])


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with every confirmed span replaced by its kind in brackets.

    Kinds are masked one after another, secrets first; each is searched in what
    those before it left.  Null texts stay null; columns are those of ``docs``.
    """
    for kind in [KINDS[-1], *KINDS[:-1]]:
        text = F.col("text").cast("string")

        def masked(p: Column) -> Column:
            parts = F.transform(_confirmed(kind, p), lambda s, i: F.concat(F.get(p["gaps"], i), F.when(s.isNull(), F.get(p["found"], i)).otherwise(F.lit(f"[{kind.name}]"))))  # noqa: B023
            return F.concat(F.array_join(parts, ""), F.element_at(p["gaps"], -1))

        docs = docs.withColumn("text", F.when(text.rlike(_NEEDS[kind.name]), _once(_pieces(kind, text), masked)).otherwise(text))
    return docs


def digest(found: DataFrame) -> DataFrame:
    """Counts, ``kind:start:end`` lists and the hash of the base kinds' list."""

    def one(kind: Kind, scores: bool) -> Column:
        return F.transform(kind.name, lambda s: F.concat_ws(":", F.lit(kind.name), s["start"], s["end"], *([F.round(s["score"], 2)] if scores else [])))

    def listed(kinds: list[Kind], scores: bool = False) -> Column:
        return F.array_join(F.concat(*[one(k, scores) for k in kinds]), ",")

    return found.select(
        "doc_id",
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(listed([k for k in KINDS if k.base]).cast("binary"), 256).alias("base_sha256"),
        listed(KINDS).alias("spans"),
        listed(KINDS, True).alias("scored_spans"),
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in KINDS if not k.base],
        F.aggregate(F.array(*[F.size(k.name) for k in KINDS]), F.lit(0).cast("long"), lambda a, n: a + n).alias("n_private"),
    )
