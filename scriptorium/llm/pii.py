"""Personal data: format-preserving pseudonyms by Feistel networks, in DataFrame functions only.

Validated values are permuted by key within their format, so equal values get equal pseudonyms in all documents
and no two values share one. Card numbers (13 to 19 digits, Luhn) permute their digits before the check digit,
which is computed anew; they are looked for among all divisions of a run of digit groups, so that neighbouring
numbers hide none; phone numbers permute their digits in place; addresses of the internet permute 32 bits;
dates permute the day within a cycle of 400 years (146,097 days = 189 x 773). Mail addresses keep their domain and
permute the letters and digits of the name, each within its own alphabet. Values that fail validation stay, so do
phone numbers and dates in other forms than +1 (234) 567-8901 and 2024-02-29, and octets with leading zeros.
Each round's function is SHA-256 over key, kind, round and the other half. Work is per row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.vectors import let

ROUNDS = 8
_MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}"
_DATE = r"(?:18|19|20|21)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d-])"
_IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d.]?\d)"
#: Order of kinds: the first alternative that matches at a place holds. A card's is a whole run of groups of digits, to be divided; a blank ends it where another kind begins.
PATTERNS = (
    ("mail", _MAIL),
    ("date", _DATE),
    ("ip", _IP),
    ("phone", r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}(?!\d)"),
    ("card", rf"(?=\d(?:[ -]?\d){{12}})\d++(?:(?:-| (?!{_MAIL}|{_DATE}|{_IP}))\d++)*+"),
)
ANY = r"(?<![A-Za-z0-9+.@-])(?:" + "|".join(p for _, p in PATTERNS) + ")"
KINDS = tuple(k for k, _ in PATTERNS)
#: What only the card's pattern matches: a run of digits of 13 or more.
RUN = r"^(?=\d(?:[ -]?\d){12})[\d -]+$"
WALKS = 64
EPOCH, CYCLE = "1800-01-01", (189, 773)


def _feistel(left, right, a, b, key: str, kind: str, back: bool = False):
    """Permutes pairs of [0, a) x [0, b); back inverts. A struct (l, r)."""
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    sign = -1 if back else 1

    def step(s, n):
        odd = n % 2 == 1
        return F.struct(
            F.when(~odd, F.pmod(s["l"] + sign * _mix(key, kind, n, s["r"], a), a)).otherwise(s["l"]).alias("l"),
            F.when(odd, F.pmod(s["r"] + sign * _mix(key, kind, n, s["l"], b), b)).otherwise(s["r"]).alias("r"))

    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(n) for n in order]), state, step)


def _mix(key: str, kind: str, n, half, modulus):
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), modulus)


def _power(n):
    return F.pow(F.lit(10.0), n).cast("long")


def _digits(column):
    return F.regexp_replace(column, r"\D", "")


def permuted_digits(digits, key: str, kind: str, back: bool = False):
    """A string of digits, two at least, permuted among those of its length."""
    n = F.char_length(digits)
    half = F.floor(n / 2).cast("int")
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)
    pair = _feistel(left, right, _power(half), _power(n - half), key, kind, back)
    return F.concat(F.right(F.concat(F.lit("0" * 19), pair["l"].cast("string")), half),
                    F.right(F.concat(F.lit("0" * 19), pair["r"].cast("string")), n - half))


def luhn_sum(digits):
    """Luhn sum of a digit string whose last digit is the check digit."""
    places = F.split(F.reverse(digits), "")
    return F.aggregate(F.transform(F.filter(places, lambda c: c != ""), lambda c, k: F.when(k % 2 == 0, c.cast("int")).otherwise(
        F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") / 5).cast("int"))), F.lit(0), lambda a, x: a + x)


def _in_place(shape, digits):
    """Digits put where the digits of shape stand."""
    chars = F.filter(F.split(shape, ""), lambda c: c != "")
    put = F.aggregate(chars, F.struct(F.lit(1).alias("k"), F.lit("").alias("s")), lambda acc, c: F.struct(
        F.when(c.rlike(r"\d"), acc["k"] + 1).otherwise(acc["k"]).alias("k"),
        F.concat(acc["s"], F.when(c.rlike(r"\d"), F.substr(digits, acc["k"], F.lit(1))).otherwise(c)).alias("s")))
    return put["s"]


def kind_of(value):
    """The kind of a matched and validated value, or null."""
    digits = _digits(value)
    octets = F.split(value, r"\.")
    checks = {
        "mail": value.contains("@"),
        "date": value.rlike(r"^\d{4}-\d\d-\d\d$") & F.try_to_date(value, "yyyy-MM-dd").isNotNull(),
        "ip": value.rlike(r"^\d+\.\d+\.\d+\.\d+$") & F.forall(octets, lambda o: o.rlike("^(?:0|[1-9][0-9]*)$") & (o.cast("int") <= 255)),
        "phone": value.startswith("+"),
        "card": value.rlike(r"^\d[\d -]+\d$") & F.char_length(digits).between(13, 19) & (F.pmod(luhn_sum(digits), F.lit(10)) == 0),
    }
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(checks[kind], kind).otherwise(out)
    return out


def pseudonym(value, kind, key: str, back: bool = False):
    """The pseudonym of a value of a kind; with back the value of a pseudonym."""
    digits = _digits(value)
    n = F.char_length(digits)
    body = permuted_digits(F.substr(digits, F.lit(1), n - 1), key, "card", back)
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    card = _in_place(value, F.concat(body, check))
    phone = _in_place(value, permuted_digits(digits, key, "phone", back))
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    ip = _feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, "ip", back)
    shown = F.concat_ws(".", F.floor(ip["l"] / 256), F.pmod(ip["l"], F.lit(256)), F.floor(ip["r"] / 256), F.pmod(ip["r"], F.lit(256)))
    day = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), F.lit(EPOCH).cast("date"))
    pair = _feistel(F.floor(day / CYCLE[1]), F.pmod(day, F.lit(CYCLE[1])), F.lit(CYCLE[0]), F.lit(CYCLE[1]), key, "date", back)
    date = F.date_format(F.date_add(F.lit(EPOCH).cast("date"), (pair["l"] * CYCLE[1] + pair["r"]).cast("int")), "yyyy-MM-dd")
    return F.when(kind == "card", card).when(kind == "phone", phone).when(kind == "ip", shown).when(kind == "date", date).when(kind == "mail", _mail(value, key, back)).otherwise(value)


def _groups(run):
    """Groups of digits, each with the separator before it."""
    return F.regexp_extract_all(run, F.lit(r"[ -]?\d+"), F.lit(0))


def _joined(groups, first, last):
    return F.array_join(F.slice(groups, first, F.greatest(last - first + 1, F.lit(0))), "")


def _is_card(value):
    digits = _digits(value)
    return F.char_length(digits).between(13, 19) & (F.pmod(luhn_sum(digits), F.lit(10)) == 0)


def _greedy(groups):
    """Spans (s, e) of groups that make valid cards, those that end first before others, the longest of an end."""
    kind = "array<struct<s:int,e:int>>"

    def step(acc, e):
        starts = F.filter(F.sequence(F.greatest(acc["lo"], e - 18), e), lambda s: _is_card(_joined(groups, s, e)))
        return let(starts, lambda x: F.when(F.size(x) > 0, F.struct((e + 1).alias("lo"), F.concat(acc["out"], F.array(F.struct(x[0].alias("s"), e.alias("e")))).alias("out"))).otherwise(acc))

    return F.aggregate(F.sequence(F.lit(1), F.size(groups)), F.struct(F.lit(1).alias("lo"), F.array().cast(kind).alias("out")), step)["out"]


def cards_in(run):
    """Spans (s, e) of groups of a run that are cards: the whole run if it is one."""
    return let(_groups(run), lambda groups: F.when(F.size(groups) == 0, F.array().cast("array<struct<s:int,e:int>>")).when(
        _is_card(run), F.array(F.struct(F.lit(1).alias("s"), F.size(groups).alias("e")))).otherwise(_greedy(groups)))


def _run(run, spans, key: str, back: bool):
    """The run with pseudonyms for its cards. A pseudonym after which the run would be divided otherwise is
    permuted again, until the division is the same; so the way back finds the same cards."""
    return let(F.struct(_groups(run).alias("groups"), _is_card(run).alias("whole")), lambda r: _renewed(r["groups"], r["whole"], spans, key, back))


def _renewed(groups, whole, spans, key: str, back: bool):
    def step(acc, span):
        parts = F.struct(_joined(groups, acc["lo"], span["s"] - 1).alias("gap"), _joined(groups, span["s"], span["e"]).alias("card"), _joined(groups, span["e"] + 1, F.size(groups)).alias("tail"))
        own = F.array(F.struct((span["s"] - acc["lo"] + 1).alias("s"), (span["e"] - acc["lo"] + 1).alias("e")))

        def walked(p):
            def same(new):
                return whole | (~_is_card(F.concat(acc["text"], p["gap"], new, p["tail"])) & (let(_groups(F.concat(p["gap"], new)), _greedy) == own))

            def walk(w, _):
                return F.when(w["done"], w).otherwise(let(pseudonym(w["x"], F.lit("card"), key, back), lambda new: F.struct(new.alias("x"), same(new).alias("done"))))

            found = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.struct(p["card"].alias("x"), F.lit(False).alias("done")), walk)
            return F.struct((span["e"] + 1).alias("lo"), F.concat(acc["text"], p["gap"], found["x"]).alias("text"))

        return let(parts, walked)

    end = F.aggregate(spans, F.struct(F.lit(1).alias("lo"), F.lit("").alias("text")), step)
    return let(end, lambda x: F.concat(x["text"], _joined(groups, x["lo"], F.size(groups))))


def _mail(value, key: str, back: bool):
    """A Feistel network over the characters of the name: in turn each half's letters and digits are shifted within
    their own alphabets by amounts that the key, the domain, the round and the other half give. Alphabets and other
    characters stay in their places, so rounds can be undone."""
    name, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    chars = F.filter(F.split(name, ""), lambda c: c != "")
    sign = -1 if back else 1

    def shifted(own, other, n):
        seed = F.concat_ws("|", F.lit(key), F.lit("mail"), domain, n.cast("string"), F.array_join(other, ""))

        def shift(c, k):
            by = F.conv(F.substring(F.sha2(F.concat_ws("|", seed, k.cast("string")), 256), 1, 12), 16, 10).cast("long")

            def turn(base: str, size: int):
                return F.char(F.pmod(F.ascii(c) - ord(base) + sign * F.pmod(by, F.lit(size)), F.lit(size)) + ord(base))

            return F.when(c.rlike("[a-z]"), turn("a", 26)).when(c.rlike("[A-Z]"), turn("A", 26)).when(c.rlike("[0-9]"), turn("0", 10)).otherwise(c)

        return F.transform(own, shift)

    def step(s, n):
        odd = n % 2 == 1
        own, other = F.when(odd, s["r"]).otherwise(s["l"]), F.when(odd, s["l"]).otherwise(s["r"])
        return let(shifted(own, other, n), lambda new: F.struct(F.when(odd, s["l"]).otherwise(new).alias("l"), F.when(odd, new).otherwise(s["r"]).alias("r")))

    half = F.floor((F.size(chars) + 1) / 2).cast("int")
    start = let(chars, lambda c: F.struct(F.slice(c, 1, half).alias("l"), F.slice(c, half + 1, F.size(c) - half).alias("r")))
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    mixed = F.aggregate(F.array(*[F.lit(n) for n in order]), start, step)
    return let(mixed, lambda m: F.concat(F.array_join(m["l"], ""), F.array_join(m["r"], ""), F.lit("@"), domain))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found: str = "pii", back: bool = False) -> DataFrame:
    """docs, all columns, with pseudonyms in the text, and a column of the kinds found, in their order.

    A null text stays null and has no kinds; a column named as `found` is replaced; repeated rows and null ids
    are rows like others; an empty table gives no rows. With back, pseudonyms become the values again.
    """
    matches = F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0))
    values = F.transform(matches, lambda v: F.struct(v.alias("value"), F.when(~v.rlike(RUN), kind_of(v)).alias("kind"), F.when(v.rlike(RUN), cards_in(v)).alias("cards")))
    between = F.split(F.col(text_col), ANY, -1)
    renewed = F.array_join(F.zip_with(F.col("__between"), F.col("__values"), lambda b, v: F.concat(b, F.coalesce(
        F.when(F.size(v["cards"]) > 0, _run(v["value"], v["cards"], key, back)).otherwise(pseudonym(v["value"], v["kind"], key, back)), F.lit("")))), "")
    # Few texts hold any value: the others skip the functions above.
    some = docs.withColumn("__values", F.when(F.col(text_col).rlike(ANY), values))
    some = some.withColumn("__between", F.when(F.col("__values").isNotNull(), between))
    kinds = F.filter(F.flatten(F.transform("__values", lambda v: F.when(v["cards"].isNotNull(), F.transform(v["cards"], lambda _: F.lit("card"))).otherwise(F.array(v["kind"])))), lambda k: k.isNotNull())
    changed = some.withColumn(text_col, F.when(F.col("__values").isNotNull(), renewed).otherwise(F.col(text_col)))
    return changed.withColumn(found, F.coalesce(kinds, F.array().cast("array<string>"))).drop("__values", "__between")


def digest(docs: DataFrame, key: str = "public demonstration key") -> DataFrame:
    """Counts by kind and the digest of each pseudonymised text."""
    out = pseudonymise(docs.select("doc_id", "text"), key)
    return out.select("doc_id", *[F.size(F.filter("pii", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.size("pii").cast("long").alias("n_pii"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def _is(kind: str):
    return lambda k: k == kind
