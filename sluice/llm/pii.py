"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust their score.

All of it is Column expressions. A pattern's matches come from regexp_extract_all and the text between them from
split(), so a running sum of both lengths gives each span in code points. Patterns use possessive quantifiers and
start only where a run of their first characters starts, and a card's pattern asks for 13 digits at once (a run is
taken whole, so shorter ones fail later anyway): that changes no result and keeps long texts linear. An account
number's pattern takes its first four characters and looks ahead at the run of groups after them, which may go on into
the next words; of the run's beginnings that end at a word's end and pass the check, the one of the country's length
is the number, or else the longest. Searching goes on within the run, so a number right after another is found too.

Kinds: email, ip, card, phone (the base) and iban (mod 97), which this method adds. Base spans are never dropped for
their score; the score tells what to trust. Base score by kind, plus a bonus if a word that speaks of the kind stands
within the window before the span.

Defined results: a null or empty text has no span (its digest is that of the empty string), repeated rows are repeated
in the result, and columns besides those named are kept by redacted() and ignored by spans().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of each kind, in the order in which kinds are listed.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?: ?[A-Z0-9]){11,30}+[A-Za-z0-9]?))",
}
#: Lengths of account numbers by country; others may have any.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: A text without this can't match.
NEEDS = {"email": "@", "phone": "+", "ip": "."}
#: What a span of a kind is worth by itself, and the words before it that raise it.
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.9}
#: Context words in English, German, French and Spanish.
CONTEXT = {
    "email": "mail|contact|write to|@|kontakt|schreib|courriel|écri|correo|escrib",
    "ip": r"\bip\b|host|server|address|addr|serv|adress|direcci",
    "card": "card|visa|master|amex|payment|credit|karte|kredit|zahlung|carte|paiement|tarjeta|pago",
    "phone": "phone|call|tel|mobile|fax|handy|anruf|rufnummer|tél|appel|portable|móvil|llam",
    "iban": "iban|account|bank|konto|compte|banque|cuenta|banco",
}
BONUS, WINDOW = 0.2, 40
#: Matches of a text that are placed at a time.
PART = 128
#: Code points of a block of a text in which spans are replaced.
BLOCK = 4096


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check over a string of digits."""

    def weighed(c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weighed), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(iban: Column) -> Column:
    """The account number check: country and check digits go last, letters count from 10, rest 1 modulo 97."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.split(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4)), "")

    def step(a: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return F.when(c == "", a).otherwise((a * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(moved, F.lit(0), step) == 1


def _holds(kind: str, x: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(F.split(x, r"\."), lambda p: F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 4).try_cast("int"), F.lit(0)) <= 255)
    if kind == "card":
        return F.length(_digits(x)).between(13, 19) & luhn(_digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return x.isNotNull()


def _account(run: Column) -> Column:
    """The account number at the start of a run of groups and the character after it, or null."""
    lengths = F.create_map(*(F.lit(x) for n, countries in IBAN_LENGTHS.items() for c in countries.split() for x in (c, n)))

    def plain(x: Column) -> Column:
        return F.length(F.replace(x, F.lit(" "), F.lit("")))

    def beginnings(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, F.lit(1), i), " "))

    def best(good: Column) -> Column:
        usual = F.filter(good, lambda x: plain(x) == F.try_element_at(lengths, F.substring(x, 1, 2)))
        return F.coalesce(F.get(usual, F.lit(0)), F.get(good, F.size(good) - 1))

    found = F.transform(F.array(F.split(run, " ")), lambda w: F.filter(beginnings(w), lambda x: plain(x).between(15, 34) & x.rlike("^[A-Z0-9 ]+$") & mod97(x)))
    return F.transform(found, best)[0]


def _placed(kind: str, pairs: Column) -> Column:
    """Array of struct(kind, s, e, v, before) of pairs (match m, text b before it) that follow one another.

    Arrays grow by copying, so PART pairs at a time are placed from 0, and the parts are moved to where they start.
    """
    spans = "array<struct<kind:string,s:int,e:int,v:string,before:string>>"

    def start(kind: str) -> Column:
        return F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(a: Column, pair: Column) -> Column:
        s = a["at"] + F.length(pair["b"])
        e = s + F.length(pair["m"])
        value = pair["run"] if kind == "iban" else pair["m"]
        one = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), value.alias("v"), F.right(pair["b"], F.lit(WINDOW)).alias("before"))
        return F.struct(e.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    def join(a: Column, part: Column) -> Column:
        one = F.struct(a["at"].alias("base"), part["out"].alias("spans"))
        return F.struct((a["at"] + part["at"]).alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    def moved(part: Column) -> Column:
        return F.transform(part["spans"], lambda x: F.struct(x["kind"].alias("kind"), (x["s"] + part["base"]).alias("s"), (x["e"] + part["base"]).alias("e"), x["v"].alias("v"), x["before"].alias("before")))

    def whole(p: Column) -> Column:
        parts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(p) - 1) / PART).cast("int")))
        local = F.transform(parts, lambda i: F.aggregate(F.slice(p, i * PART + 1, F.lit(PART)), start(spans), step))
        return F.flatten(F.transform(F.aggregate(local, start(f"array<struct<base:int,spans:{spans}>>"), join, lambda a: a["out"]), moved))

    return F.transform(F.array(pairs), whole)[0]  # so that the pairs are found once


def _found(kind: str, text: Column) -> Column:
    """Array of struct(kind, s, e, score): the spans of a kind in order, in code points, end exclusive."""
    pattern = PATTERNS[kind]
    got, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(got, F.slice(between, F.lit(1), F.size(got)), lambda m, b: F.struct(m.alias("m"), b.alias("b")))
    if kind == "iban":
        pairs = F.zip_with(pairs, F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda p, more: F.struct(p["m"].alias("m"), p["b"].alias("b"), F.concat(p["m"], more).alias("run")))
    placed = _placed(kind, pairs)
    if kind == "iban":
        known = F.transform(placed, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), _account(x["v"]).alias("v"), x["before"].alias("before")))
        placed = F.transform(known, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), (x["s"] + F.length(x["v"])).alias("e"), x["v"].alias("v"), x["before"].alias("before")))
    kept = F.filter(placed, lambda x: _holds(kind, x["v"]))
    scored = F.transform(kept, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), (F.lit(SCORES[kind]) + F.when(F.lower(x["before"]).rlike(CONTEXT[kind]), BONUS).otherwise(0.0)).alias("score")))
    needs = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)
    none = F.array().cast("array<struct<kind:string,s:int,e:int,score:double>>")
    return F.when(needs & F.regexp_like(text, F.lit(pattern)), scored).otherwise(none)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id and, for each kind, the array of struct(kind, s, e, score) of its spans in the whole text."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), *(_found(k, text).alias(k) for k in PATTERNS))


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, base_sha256, spans (all of them) and scores, likewise joined."""
    base = [k for k in PATTERNS if k != "iban"]
    found = spans(docs)
    all_base = F.concat(*(F.col(k) for k in base))
    everything = F.concat(*(F.col(k) for k in PATTERNS))
    return found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in base), F.sha2(_listed(all_base), 256).alias("base_sha256"), _listed(everything).alias("spans"), F.array_join(F.transform(everything, lambda x: x["score"].cast("string")), ",").alias("scores"))


def redacted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """docs with every span of at least the given score replaced by its kind in brackets, and n_chars after it.

    Overlapping spans are one, named by the kind that starts first. A null text stays null.
    """
    text = F.col("text")
    everything = F.array_sort(F.filter(F.concat(*(F.transform(_found(k, F.coalesce(text, F.lit(""))), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), x["score"].alias("score"))) for k in PATTERNS)), lambda x: x["score"] >= least))

    spans = F.col("__spans")

    def one(block: Column, i: Column) -> Column:
        """A block of the text with what starts in it replaced; a span from an earlier block may reach into it."""
        first = i * BLOCK
        mine = F.filter(spans, lambda x: (x["s"] >= first) & (x["s"] < first + BLOCK))
        covered = F.aggregate(F.filter(spans, lambda x: x["s"] < first), F.lit(0), lambda a, x: F.greatest(a, x["e"]))

        def step(a: Column, x: Column) -> Column:
            piece = F.concat(F.substring(block, a["at"] - first + 1, x["s"] - a["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
            return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(piece))).otherwise(a["out"]).alias("out"))

        start = F.struct(F.greatest(covered, first).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(mine, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(block, a["at"] - first + 1)))

    # texts are cut into blocks in one pass, so that no span's place is counted from the text's beginning
    done = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), one), "")
    out = docs.withColumn("__spans", everything).withColumn("text", F.when(F.size("__spans") > 0, done).otherwise(text)).drop("__spans")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
