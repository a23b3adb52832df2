"""Benchmark decontamination: template windows joined by hash, then a check that slots were filled consistently.

Numbers, units and names become typed placeholders, so a question keeps its windows when its values are changed. Windows
that line up with a benchmark item lead to a comparison of the whole item token by token; it is held when each of its
values stands for one value of the document. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_or_plain, table_within
from tidemark.session import keep

WINDOW = 8  # tokens
LEAST_ITEM = 5  # shorter items take no part
LEAST_RUN = 13  # matching tokens in line, or the whole item if it is shorter
STRIDE = 3  # of a document's windows for items of LEAST_RUN tokens: two of a run's six windows are looked up
MIXED = 6  # capitalised words of an item's window that are each taken as word and as name

# Units that follow a number, every spelling with the one that stands for it.
UNIT_SPELLINGS = {
    "kg": "kg kilo kilos kilogram kilograms kilogramme kilogrammes",
    "mg": "mg milligram milligrams",
    "g": "g gram grams gramme grammes",
    "km": "km kilometre kilometres kilometer kilometers",
    "cm": "cm centimetre centimetres centimeter centimeters",
    "mm": "mm millimetre millimetres millimeter millimeters",
    "m": "m metre metres meter meters",
    "mile": "mile miles",
    "ft": "ft foot feet",
    "in": "inch inches",
    "l": "l litre litres liter liters",
    "ml": "ml millilitre millilitres milliliter milliliters",
    "h": "hour hours hr hrs",
    "min": "minute minutes min mins",
    "s": "second seconds sec secs",
    "day": "day days",
    "week": "week weeks",
    "month": "month months",
    "year": "year years",
    "dollar": "dollar dollars",
    "cent": "cent cents",
    "euro": "euro euros",
    "pound": "pound pounds",
    "percent": "percent",
    "mph": "mph",
    "kmh": "kmh",
}
UNIT_OF = {word: unit for unit, words in UNIT_SPELLINGS.items() for word in words.split()}
UNITS = "|".join(sorted(UNIT_OF, key=lambda w: (-len(w), w)))

# Number words.
NUMBER_WORDS = {
    "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10",
    "eleven": "11", "twelve": "12", "thirteen": "13", "fourteen": "14", "fifteen": "15", "sixteen": "16", "seventeen": "17",
    "eighteen": "18", "nineteen": "19", "twenty": "20", "thirty": "30", "forty": "40", "fifty": "50", "sixty": "60",
    "seventy": "70", "eighty": "80", "ninety": "90", "hundred": "100", "thousand": "1000", "million": "1000000",
}

# Marks from the private-use area: a name, a unit, a capitalised word at a start (word or name); a number in templates.
NAME, UNIT, START, NUMBER = "\ue000", "\ue001", "\ue002", "\ue003"
_MARKS = f"[{NAME}{UNIT}{START}{NUMBER}]"
_SLOT = f"[{NAME}{UNIT}{NUMBER}]"
_SIGNS = "%$€£°"
_NUMBER = r"\d+(?:[.,]\d+)*"
# Scripts written without spaces: each character is a token.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
# Latin letters are told by their range first; the scripts are looked up for other letters alone.
_LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_OTHER = rf"[\p{{L}}&&[^{_UNSPACED}]]"
_TOKEN = (
    rf"{_MARKS}?[{_LATIN}{_OTHER}][{_LATIN}'’{_OTHER}\p{{M}}]*+|{_NUMBER}|[{_SIGNS}]"
    rf"|[\p{{L}}&&[{_UNSPACED}]]\p{{M}}*+"
)
# Six slots with two words between them at most: windows of which two words are plain, or fewer, lie in such stretches.
_DENSE = f"{_SLOT}(?: (?:[^ {NAME}{UNIT}{NUMBER}]+ ){{0,2}}{_SLOT}){{5}}"


def _without(text: Column, signs: str, instead: str = "") -> Column:
    """``text`` with each of the signs replaced; whole strings are searched, where translate looks up every character."""
    for sign in signs:
        text = F.replace(text, F.lit(sign), F.lit(instead))
    return text


def surface_tokens(text: Column) -> Column:
    """Words, numbers and unit signs in order; names, units and words that may be names carry their mark.

    A capitalised word is a name after a lower-case letter, digit or comma and a space; elsewhere (at a sentence or line
    start) it is a word or a name. Digits grouped by spaces are one number in front of a unit.
    """
    text = _without(text, NAME + UNIT + START + NUMBER)
    grouped = rf"(?<=\d)[ \u00a0\u202f](?=(?:\d{{3}}[ \u00a0\u202f])*\d{{3}}[ \u00a0\u202f](?:{UNITS})(?![\p{{L}}\p{{N}}]))"
    text = F.regexp_replace(text, grouped, "")
    text = F.regexp_replace(text, rf"(?<=\d)([ \u00a0\u202f]?)((?:{UNITS})(?![\p{{L}}\p{{N}}]))", f" {UNIT}$2")
    # Capitals are looked for first: few places go on to look behind.
    text = F.regexp_replace(text, r"(?=[A-Z\p{Lu}][a-z\p{Ll}])(?<=[a-z0-9,;\p{Ll}\p{Nd}] )", NAME)
    text = F.regexp_replace(text, rf"(?=[A-Z\p{{Lu}}][a-z\p{{Ll}}])(?<![a-zA-Z\p{{L}}\p{{M}}'’{NAME}{UNIT}{START}])", START)
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def bare(token: Column) -> Column:
    return F.lower(_without(token, NAME + UNIT + START))


def _either(word: Column, names) -> Column:
    return word.isin(*names)


def kind_of(token: Column) -> Column:
    """The kind of slot a token fills; null for a word, also for one that may be a name."""
    first = F.substring(token, 1, 1)
    return (
        F.when(first == NAME, "<name>")
        .when((first == UNIT) | first.isin(*_SIGNS), "<unit>")
        .when(first.between("0", "9") | first.rlike(r"^\d") | _either(bare(token), NUMBER_WORDS), "<number>")
    )


def value_of(token: Column) -> Column:
    """What a token says: number words as digits, every spelling of a unit as one."""
    said = F.create_map(*[F.lit(x) for pair in {**NUMBER_WORDS, **{w: u for w, u in UNIT_OF.items() if len(w) > 1}}.items() for x in pair])
    return F.coalesce(F.try_element_at(said, bare(token)), bare(token))


# The forms in which windows are looked up: starts as words, starts as names, and literally.
FORMS = ("words", "names", "exact")


def templates(frame: DataFrame, tokens: Column, *columns: str) -> DataFrame:
    """(columns, words, names, exact): the tokens of each form, as text with a blank between them.

    Slots are single marks. The whole text is rewritten at once, so no token passes through an interpreted function.
    """
    # A blank stands before each token here, so numbers are looked for behind blanks alone.
    number = rf" {START}?(?=[\d{''.join(sorted({w[0] for w in NUMBER_WORDS}))}])(?:\d[^ ]*|(?:{'|'.join(NUMBER_WORDS)})(?![^ ]))"
    lower = frame.select(*columns, F.lower(F.array_join(tokens, " ")).alias("lower"))
    slots = _without(F.regexp_replace(F.concat(F.lit(" "), "lower"), f"([{NAME}{UNIT}])[^ ]+", "$1"), _SIGNS, UNIT)
    slots = F.substring(F.regexp_replace(slots, number, f" {NUMBER}"), 2, 1 << 30)
    slots = lower.select(*columns, slots.alias("slots"), _without(F.col("lower"), NAME + UNIT + START).alias("exact"))
    return slots.select(*columns, _without(F.col("slots"), START).alias("words"), F.regexp_replace("slots", f"{START}[^ ]+", NAME).alias("names"), "exact")


def _split(text: str) -> Column:
    return F.when(F.col(text) == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def _window(hashes, at: Column, width: int) -> Column:
    return F.xxhash64(*(hashes[at + j] for j in range(width)))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(form, width, long, hash, item, at) of all windows; ``items`` has (item, tokens).

    A window without a plain word is listed literally alone. In any other, each word that may be a name is taken as word
    and as name (all or none of them, if there are more than ``MIXED``). ``long`` tells items of ``LEAST_RUN`` tokens.
    """
    size = F.size("tokens")
    sized = items.select("item", F.least(F.lit(WINDOW), size).alias("width"), (size >= LEAST_RUN).alias("long"), "tokens").where(size >= LEAST_ITEM)
    sized = templates(sized, F.col("tokens"), "item", "width", "long")
    sized = sized.select("item", "width", "long", *[_split(f).alias(f) for f in FORMS])
    parts = None
    for n in range(LEAST_ITEM, WINDOW + 1):
        each = sized.where(F.col("width") == n).select("item", "width", "long", F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("at"), *FORMS)
        each = each.select("item", "width", "long", "at", *[F.slice(f, F.col("at") + 1, n).alias(f) for f in FORMS])
        starts = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.get("words", j) != F.get("names", j))
        each = each.withColumn("starts", starts)
        every = F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), F.size("starts")) - 1)
        each = each.withColumn("masks", F.when(F.size("starts") <= MIXED, every).otherwise(F.array(F.lit(0), F.lit((1 << n) - 1))))
        mixed = each.select("item", "width", "long", "at", "words", "names", "exact", "starts", F.explode("masks").alias("mask"))

        def taken(j: int) -> Column:
            rank = F.array_position("starts", F.lit(j)).cast("int")
            as_name = (rank > 0) & (F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), F.greatest(rank - 1, F.lit(0)))) != 0)
            return F.when(as_name, F.get("names", F.lit(j))).otherwise(F.get("words", F.lit(j)))

        chosen = mixed.withColumn("chosen", F.array(*[taken(j) for j in range(n)]))
        plain = F.exists("chosen", lambda t: ~t.rlike(f"^{_SLOT}$"))
        template = chosen.where(plain).select(F.lit("template").alias("form"), "width", "long", _hash("chosen", n).alias("hash"), "item", "at")
        literal = each.where(F.forall("words", lambda t: t.rlike(f"^{_SLOT}$"))).select(F.lit("exact").alias("form"), "width", "long", _hash("exact", n).alias("hash"), "item", "at")
        own = template.unionByName(literal)
        parts = own if parts is None else parts.unionByName(own)
    return parts.distinct()


def _hash(tokens: str, width: int) -> Column:
    return F.xxhash64(*(F.xxhash64(F.get(tokens, F.lit(j))) for j in range(width)))


def document_windows(tokens: DataFrame, kinds: set[tuple[str, int, bool]], *columns: str) -> DataFrame:
    """(columns, pos, width, hash) of the windows that items of these kinds (form, width, long) can be met by.

    ``tokens`` has a column of that name. For items of LEAST_RUN tokens every STRIDE-th window is enough: two of them lie
    in each run, and where neither has a plain word the run lies in a dense stretch. Documents with such a stretch, and
    shorter items, have every window looked up.
    """
    forms = ["words", "names", *(["exact"] if any(f == "exact" for f, _, _ in kinds) else [])]
    texts = templates(tokens, F.col("tokens"), *columns)
    step = F.when(F.col("names").rlike(_DENSE), 1).otherwise(STRIDE)
    hashes = texts.select(*columns, step.alias("step"), *[F.transform(_split(f), lambda t: F.xxhash64(t)).alias(f) for f in forms])
    lists = []
    for width, every in sorted({(n, not long) for _, n, long in kinds}):
        starts = F.sequence(F.lit(0), F.size("words") - width, F.lit(1) if every else F.col("step"))
        each = F.transform(starts, lambda i: F.struct(i.alias("pos"), F.lit(width).alias("width"), *(_window(F.col(f), i, width).alias(f) for f in forms)))  # noqa: B023
        none = F.array().cast(f"array<struct<pos:int,width:int,{','.join(f'{f}:bigint' for f in forms)}>>")
        lists.append(F.when(F.size("words") >= width, each).otherwise(none))
    placed = hashes.select(*columns, F.inline(F.concat(*lists) if len(lists) > 1 else lists[0]))
    # Most windows are the same in both forms and looked up once.
    other = F.when(F.col("words") == F.col("names"), F.array("words")).otherwise(F.array("words", "names"))
    wanted = F.concat(other, F.array("exact")) if "exact" in forms else other
    return placed.select(*columns, "pos", "width", F.explode(wanted).alias("hash"))


def whole_match(item: Column, doc: Column, shift: Column) -> Column:
    """True where a run of ``LEAST_RUN`` tokens of the item, or all, match the document's at ``shift`` with one value each.

    A run without a plain word is no template: it must be literally the same.
    """
    def pair(i):
        a, b = F.get(item, i), F.get(doc, i + shift)
        first = lambda t: F.substring(t, 1, 1)
        equal = value_of(a) == value_of(b)
        name = first(a).isin(NAME, START) & first(b).isin(NAME, START)
        # A start that is the same word is a word; any other placeholder is a slot.
        word = kind_of(a).isNull() & equal
        same = equal | name | F.coalesce(kind_of(a) == kind_of(b), F.lit(False))
        return F.struct(value_of(a).alias("item"), value_of(b).alias("doc"), F.coalesce(same, F.lit(False)).alias("same"), F.coalesce(word, F.lit(False)).alias("word"), F.coalesce(equal, F.lit(False)).alias("equal"))

    size = F.size(item)
    pairs = F.transform(F.sequence(F.lit(0), size - 1), pair)
    breaks = lambda p: F.concat(F.array(F.lit(-1)), F.filter(F.transform(p, lambda x, i: F.when(~x.same, i)), lambda i: i.isNotNull()), F.array(size))

    def fits(run):
        slots = F.array_distinct(F.transform(F.filter(run, lambda x: ~x.word), lambda x: F.struct(x["item"].alias("item"), x["doc"].alias("doc"))))
        one_each = F.size(F.array_distinct(F.transform(slots, lambda s: s["item"]))) == F.size(slots)
        return one_each & (F.exists(run, lambda x: x.word) | F.forall(run, lambda x: x.equal))

    def runs(p, cuts):
        spans = F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), lambda k: F.struct((F.get(cuts, k) + 1).alias("low"), (F.get(cuts, k + 1) - F.get(cuts, k) - 1).alias("n")))
        return F.exists(spans, lambda s: (s.n >= F.least(F.lit(LEAST_RUN), size)) & fits(F.slice(p, s.low + 1, F.greatest(s.n, F.lit(0)))))

    # Each list is worked out once: transform binds it.
    return F.transform(F.array(pairs), lambda p: F.transform(F.array(breaks(p)), lambda cuts: runs(p, cuts))[0])[0]


def row_key(text: Column) -> list[Column]:
    """Rows with one id and one text are one case; these columns, beside the id, tell texts apart."""
    return [F.xxhash64(text).alias("_hash"), F.length(text).alias("_length")]


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, _hash, _length, item_ids): the documents that hold benchmark items, one row for each id and text.

    An item is held where at least ``LEAST_RUN`` tokens in line match it as a template (all of them, if it has fewer) and
    each of its values stands for one value. Items of fewer than ``LEAST_ITEM`` tokens and null or empty texts on either
    side match nothing.
    """
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("item_text")).where("item_text is not null")
    # Items are numbered by their text: repeated items are matched once and listed by all their ids.
    items = items.groupBy("item_text").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    items = keep(items.select(F.xxhash64("item_text").alias("item"), "item_ids", surface_tokens(F.col("item_text")).alias("tokens")), "benchmark-items")
    index = keep(benchmark_windows(items), "benchmark-windows")
    kinds = {(r.form, r.width, r.long) for r in index.select("form", "width", "long").distinct().collect()}  # a dozen at most

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    key = ["doc_id", "_hash", "_length"]
    if not kinds:
        return rows.select("doc_id", *row_key(F.col("text")), F.array().cast("array<bigint>").alias("item_ids")).limit(0)
    tokens = rows.select("doc_id", *row_key(F.col("text")), surface_tokens(F.col("text")).alias("tokens"))
    found = document_windows(tokens, kinds, *key)
    found = found.join(table_within(index.select("width", "hash", "item", "at").distinct(), 64), ["width", "hash"])

    # One line is an item laid against a document at one place; repeated rows fall together here.
    line = [*key, "item", (F.col("pos") - F.col("at")).alias("shift")]
    lines = keep(found.select(*line).distinct(), "template-lines")
    wanted = small_or_plain(keep(lines.select(*key).distinct(), "template-documents"))
    # Only documents with a line are read again, for all tokens in line with an item.
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_hash"] == b["_hash"]) & (a["_length"] == b["_length"])
    again = rows.select("doc_id", *row_key(F.col("text")), "text").alias("d")
    again = again.join(wanted.alias("w"), same({k: F.col(f"d.{k}") for k in key}, {k: F.col(f"w.{k}") for k in key}), "left_semi")
    values = again.dropDuplicates(key).select(*key, surface_tokens(F.col("text")).alias("tokens"))
    sized = lines.join(table_within(keep(items.select("item", F.size("tokens").alias("size")), "benchmark-sizes"), 64), "item")
    joined = sized.alias("l").join(values.alias("v"), same({k: F.col(f"l.{k}") for k in key}, {k: F.col(f"v.{k}") for k in key}))
    # A line takes along the document's stretch beside the item, not the document.
    low = F.greatest(F.col("shift"), F.lit(0))
    stretch = F.slice(F.col("v.tokens"), low + 1, F.greatest(F.col("shift") + F.col("size") - low, F.lit(0)))
    joined = joined.select(*[f"l.{k}" for k in key], "l.item", (F.col("shift") - low).alias("shift"), stretch.alias("doc_tokens"))
    joined = joined.distinct().join(items.withColumnRenamed("tokens", "item_tokens"), "item")
    fits = whole_match(F.col("item_tokens"), F.col("doc_tokens"), F.col("shift"))
    held = joined.where(fits).select(*key, F.explode("item_ids").alias("item_id"))
    return held.groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def marked(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "item_ids") -> DataFrame:
    """All columns of ``docs`` and ``name``, the benchmark items a row holds; empty for clean rows.

    Repeated rows are each marked; a column of ``docs`` with that name is replaced, no other is touched.
    """
    found = table_within(keep(leaks(docs, benchmark, doc_id, text), "leaks"), 64)
    whole = F.col(f"`{text}`").cast("string")
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != name]).alias("row"), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(whole).alias("hash"), F.length(whole).alias("length"))
    on = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("_hash")) & (F.col("length") == F.col("_length"))
    return left.join(found, on, "left").select("row.*", F.coalesce("item_ids", F.array().cast("array<bigint>")).alias(name))
