"""Personal data: keyed surrogates of the same kind, script and format, distinct for distinct values.

One value has one surrogate everywhere, whatever its punctuation. Different values of a kind never share a surrogate, and
no surrogate is a value that the corpus itself holds: colliding values are keyed anew until none is left. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, small_or_plain
from tidemark.session import keep

# Titles by gender, and first names of surrogates.
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madame", "Mme", "Frau", "Señora", "Sra", "Госпожа")
MALE_TITLES = ("Mr", "Monsieur", "Herr", "Señor", "Sr", "Господин")
OTHER_TITLES = ("Dr", "Prof")
FIRST_NAMES = {
    ("female", "latin"): ("Anna", "Clara", "Emma", "Julia", "Laura", "Maria", "Nora", "Sara"),
    ("male", "latin"): ("Adam", "David", "Felix", "Leon", "Martin", "Oscar", "Paul", "Victor"),
    ("either", "latin"): ("Alex", "Andrea", "Charlie", "Kim", "Robin", "Sam", "Sascha", "Toni"),
    ("female", "cyrillic"): ("Анна", "Вера", "Ирина", "Мария", "Нина", "Ольга", "Софья", "Елена"),
    ("male", "cyrillic"): ("Антон", "Борис", "Иван", "Лев", "Олег", "Павел", "Роман", "Юрий"),
    ("either", "cyrillic"): ("Саша", "Женя", "Валя", "Шура", "Слава", "Паша", "Вика", "Лёва"),
}

_TITLES = "|".join(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES)
#: Kinds by priority: where two could begin at one place, the first is taken.
KINDS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]+@[\p{L}\p{M}\p{N}-]+(?:\.[\p{L}\p{M}\p{N}-]+)+",
    "ip": r"(?<![\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\p{N}]|\.[0-9])"
    r"|(?<![\p{L}\p{N}:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "card": r"(?<![\p{N}-])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![\p{N}-])",
    "ssn": r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    "phone": r"(?<![\p{N}+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![\p{N}])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![\p{N}])"
    r"|(?<![\p{N}+.-])(?:[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}|0[0-9]{2,4}[ /-][0-9]{6,8})(?![\p{N}-]|\.[0-9])",
    "name": rf"(?<![\p{{L}}])(?:{_TITLES})\.? \p{{Lu}}[\p{{Ll}}]+(?: \p{{Lu}}[\p{{Ll}}]+)?",
}
HINT = rf"[0-9@]|::|(?:{_TITLES})"

_SMALL, _LARGE = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SMALL_CYRILLIC, _LARGE_CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"
_SMALL_GREEK, _LARGE_GREEK = "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"
#: Letters of scripts without case, by Unicode's name of the script.
CASELESS = {
    "Han": "".join(map(chr, range(0x4E00, 0x4F00))),
    "Hiragana": "".join(map(chr, range(0x3042, 0x3094))),
    "Katakana": "".join(map(chr, range(0x30A2, 0x30F4))),
    "Hangul": "".join(map(chr, range(0xAC00, 0xAD00))),
    "Arabic": "".join(map(chr, [*range(0x0627, 0x063B), *range(0x0641, 0x064B)])),
    "Hebrew": "".join(map(chr, range(0x05D0, 0x05EB))),
    "Devanagari": "".join(map(chr, range(0x0905, 0x093A))),
    "Thai": "".join(map(chr, range(0x0E01, 0x0E2F))),
}
ROUNDS = 40


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def pattern(kinds=None) -> str:
    return "|".join(f"(?:{p})" for p in (kinds or KINDS).values())


def kind_of(value: Column, kinds=None) -> Column:
    out = F.lit(None).cast("string")
    for name, p in reversed(list((kinds or KINDS).items())):
        # Look-around judged the surroundings already; alone, the value has none.
        out = F.when(value.rlike(rf"^(?:{p})$"), F.lit(name)).otherwise(out)
    return out


def identity(value: Column, kind: Column) -> Column:
    """What makes two mentions one entity: digits of numbers, else the lower-cased text; for names without the title's dot."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    plain = F.regexp_replace(F.lower(value), r"\.(?= )", "")
    return F.when(kind.isin("email", "ip"), lower_ascii(value)).when(kind == "name", plain).when(digits == "", plain).otherwise(digits)


def _stream(seed: Column) -> Column:
    """256 hexadecimal digits of a keyed digest."""
    return F.concat(*(F.sha2(F.concat(seed, F.lit(f"|{i}")), 256) for i in range(4)))


def _byte(stream: Column, at: Column) -> Column:
    return F.conv(F.substring(stream, (F.pmod(at, F.lit(128)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(number, F.lit(len(letters))) + 1, F.lit(1))


def _mapped(value: Column, stream: Column) -> Column:
    """Each letter or digit replaced by one of its script and case (Latin for scripts without an alphabet here), the rest kept."""

    def chosen(c, n):
        out = (
            F.when(c.rlike("[a-z]"), _pick(_SMALL, n))
            .when(c.rlike("[0-9]"), _pick("0123456789", n))
            .when(c.rlike("[A-Z]"), _pick(_LARGE, n))
            .when(~c.rlike(r"\p{L}"), c)
            .when(c.rlike(r"[\p{Lu}&&\p{IsCyrillic}]"), _pick(_LARGE_CYRILLIC, n))
            .when(c.rlike(r"\p{IsCyrillic}"), _pick(_SMALL_CYRILLIC, n))
            .when(c.rlike(r"[\p{Lu}&&\p{IsGreek}]"), _pick(_LARGE_GREEK, n))
            .when(c.rlike(r"\p{IsGreek}"), _pick(_SMALL_GREEK, n))
        )
        for script, letters in CASELESS.items():
            out = out.when(c.rlike(rf"\p{{Is{script}}}"), _pick(letters, n))
        return out.when(c.rlike(r"\p{Lu}"), _pick(_LARGE, n)).otherwise(_pick(_SMALL, n))

    def one(c, i):
        return let(_byte(stream, i), lambda n: chosen(c, n))

    letters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(letters, one), "")


def _digits(value: Column, stream: Column, kept: Column) -> Column:
    """Digits after the first ``kept`` replaced in order, so one number in two notations gets one surrogate."""
    letters = F.filter(F.split(value, ""), lambda c: c != "")

    def one(c, i):
        at = F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]") & (at > kept), _pick("0123456789", _byte(stream, at))).otherwise(c)

    return F.array_join(F.transform(letters, one), "")


def _hexadecimal(value: Column, stream: Column) -> Column:
    """Hexadecimal digits replaced by others, colons kept."""
    letters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(letters, lambda c, i: F.when(c == ":", c).otherwise(_pick("0123456789abcdef", _byte(stream, i)))), "")


def surrogate(value: Column, kind: Column, attempt: Column, key: str) -> Column:
    """The keyed replacement of one mention."""
    seed = F.concat_ws("|", F.lit(key), kind, identity(value, kind), attempt.cast("string"))
    return let(_stream(seed), lambda stream: _made(value, kind, stream))


def _made(value: Column, kind: Column, stream: Column) -> Column:
    octets = F.concat_ws(".", *(_byte(stream, F.lit(i)).cast("string") for i in range(4)))
    country = F.length(F.regexp_replace(F.regexp_extract(value, r"^\+[0-9]{1,3}(?![0-9])", 0), "[^0-9]", ""))
    # Domains of e-mail addresses keep their last label, which has a meaning.
    address = F.concat(_mapped(F.regexp_extract(value, r"^(.*)\.[^.]*$", 1), stream), F.regexp_extract(value, r"\.[^.]*$", 0))

    def person(title, rest):
        bare = F.regexp_replace(title, r"[. ]", "")
        script = F.when(rest.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
        gender = F.when(bare.isin(*FEMALE_TITLES), "female").when(bare.isin(*MALE_TITLES), "male").otherwise("either")
        names = F.create_map(*[x for (g, s), v in FIRST_NAMES.items() for x in (F.lit(f"{g} {s}"), F.array(*map(F.lit, v)))])
        first = F.element_at(names[F.concat_ws(" ", gender, script)], F.pmod(_byte(stream, F.lit(100)), F.lit(8)) + 1)
        last = _mapped(F.regexp_extract(rest, r"([^ ]+)$", 1), stream)
        return F.concat(title, F.when(F.contains(rest, F.lit(" ")), F.concat(first, F.lit(" "))).otherwise(F.lit("")), last)

    return (
        F.when(kind == "email", address)
        .when((kind == "ip") & F.contains(value, F.lit(":")), _hexadecimal(value, stream))
        .when(kind == "ip", octets)
        .when(kind == "name", person(F.regexp_extract(value, r"^[^ ]+ ", 0), F.regexp_extract(value, r"^[^ ]+ (.*)$", 1)))
        .otherwise(_digits(value, stream, F.when(kind == "phone", country).otherwise(0)))
    )


def retries(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, identity, attempt) of the entities whose first surrogate collides; ``entities`` is (kind, identity, value).

    Each round keeps what is settled, in the order of identities, and keys the others anew. Fails when ``rounds`` do not
    settle all: then a kind has more values than its format has room for.
    """
    now = keep(entities.withColumn("attempt", F.lit(0)), "entities")
    originals = now.select("kind", F.col("identity").alias("made")).withColumn("original", F.lit(True))
    for _ in range(rounds):
        kind = F.col("kind")
        made = now.withColumn("made", let(surrogate(F.col("value"), kind, F.col("attempt"), key), lambda new: identity(new, kind)))
        holders = made.groupBy("kind", "made").agg(F.min(F.struct("attempt", "identity")).alias("holder"))
        judged = made.join(holders, ["kind", "made"]).join(originals, ["kind", "made"], "left")
        clash = (F.col("holder.identity") != F.col("identity")) | F.coalesce("original", F.lit(False))
        now = keep(judged.select("kind", "identity", "value", (F.col("attempt") + clash.cast("int")).alias("attempt"), clash.alias("clash")), "entities")
        if not now.where("clash").limit(1).count():
            return now.where("attempt > 0").select("kind", "identity", "attempt")
    raise ValueError("values outnumber the surrogates that their format allows")


def replaced(docs: DataFrame, key: str, text: str = "text", out: str = "clean_text", kinds=None, rounds: int = ROUNDS) -> DataFrame:
    """All columns of ``docs``, the text with surrogates, and ``pii_kinds``: the kinds replaced, in order.

    A null text stays null with no kinds; an empty table stays empty; repeated rows get equal replacements. Columns of
    ``docs`` with the new names are replaced. ``docs`` must read alike each time it is read.
    """
    kinds = kinds or KINDS
    body = F.col(f"`{text}`").cast("string")
    found = F.when(F.coalesce(body.rlike(HINT), F.lit(False)) if kinds is KINDS else body.isNotNull(), F.regexp_extract_all(body, F.lit(pattern(kinds)), F.lit(0))).otherwise(F.array().cast("array<string>"))
    base = docs.drop(out, "pii_kinds").withColumn("_values", found)

    # One row an entity before anything is shuffled twice: repeated mentions combine inside their task.
    mentions = base.where(F.size("_values") > 0).select(F.explode("_values").alias("value"))
    mentions = mentions.withColumn("kind", kind_of(F.col("value"), kinds)).withColumn("identity", identity(F.col("value"), F.col("kind")))
    entities = mentions.groupBy("kind", "identity").agg(F.min("value").alias("value"))
    again = keep(retries(entities, key, rounds), "pii-retries")

    rows = base
    attempts = None
    if again.limit(1).count():
        # Texts with such values get their attempts by a join on the values they hold, then all go on alike.
        whose = base.where(F.size("_values") > 0).select(F.xxhash64(body).alias("_hash"), F.length(body).alias("_length"), F.explode("_values").alias("value")).distinct()
        whose = whose.withColumn("kind", kind_of(F.col("value"), kinds)).withColumn("identity", identity(F.col("value"), F.col("kind")))
        hit = whose.join(small_or_plain(again), ["kind", "identity"])
        hit = hit.groupBy("_hash", "_length").agg(F.map_from_entries(F.collect_list(F.struct("value", "attempt"))).alias("_attempts"))
        hit = small_or_plain(keep(hit, "pii-attempts"))
        rows = base.withColumns({"_hash": F.xxhash64(body), "_length": F.length(body)}).join(hit, ["_hash", "_length"], "left")
        attempts = F.col("_attempts")

    def changed(value):
        attempt = F.coalesce(attempts[value], F.lit(0)) if attempts is not None else F.lit(0)
        return let(kind_of(value, kinds), lambda kind: surrogate(value, kind, attempt, key))

    gaps = F.split(body, pattern(kinds))
    pieces = F.zip_with(gaps, F.transform("_values", changed), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    clean = F.when(F.size("_values") > 0, F.array_join(pieces, "")).otherwise(body)
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in (out, "pii_kinds")]
    return rows.select(*columns, clean.alias(out), F.transform("_values", lambda v: kind_of(v, kinds)).alias("pii_kinds"))
