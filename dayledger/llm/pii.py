"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

An entity is found by a pattern and reduced to its canonical form (digits, lower case), so
that all its spellings are one entity. Names are found behind a form of address; the rest of
the document is then searched for the same names and their parts. Each distinct entity gets
one surrogate, derived from a key, its type, its canonical form, its gender and the number of
the attempt; an attempt fails if the surrogate is another entity's or stands in the corpus
itself. Every mention is then replaced by its entity's surrogate, written the way the mention
was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.shared import NO_ID, stored

#: A local part is read once, from its start: tried at every letter, or given back letter by
#: letter, it would cost the square of a word's length.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
SECRET = r"\b(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,})\b"
#: What tells an issuer's keys stays in their surrogates; these keys are case-sensitive.
SECRET_PREFIX = r"^(?:AKIA|ghp_|sk-)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"
CARD = r"(?<![\w.+-])(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}|\d{13,19})(?![\w-]|\.\d)"
#: Length of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR PS QA UA", 30: "JO KW MU", 31: "MT",
}


def _account(length: int, countries: str) -> str:
    """Country, check digits and the rest, alone or in groups of four."""
    fours, rest = divmod(length - 4, 4)
    tail = rf" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})\d\d(?: ?[A-Z0-9]{{4}}){{{fours}}}{tail}"


IBAN = rf"\b(?=[A-Z]{{2}}\d\d)(?:{'|'.join(_account(n, c) for n, c in IBAN_LENGTHS.items())})\b"
SSN = r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])"
#: Forms of address, by which a name's gender shows.
MALE = "Mr|Herr|Señor|Sr|Monsieur|Господин|Г-н"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Госпожа|Г-жа"
ADDRESS = rf"(?<!\p{{L}})(?:{MALE}|{FEMALE})\.? "
_NAME_WORD = r"\p{Lu}[\p{Ll}'’-]*\p{Ll}(?:[-'’]\p{Lu}\p{Ll}+)*"
NAME = rf"{ADDRESS}{_NAME_WORD}(?: {_NAME_WORD}){{0,3}}"

#: In the order in which they are tried at a place of the text.
TYPES = (
    ("email", EMAIL), ("secret", SECRET), ("ip", IP), ("iban", IBAN), ("card", CARD),
    ("ssn", SSN), ("phone", PHONE), ("name", NAME),
)
PATTERN = "|".join(f"(?:{pattern})" for _, pattern in TYPES)
DIGITS = ("card", "ssn", "phone")
#: The kind of what a pattern finds and a second look rejects: it stays as it is.
NONE = "none"

#: Rounds in which a surrogate has its entity's form; after them it grows.
SAME_FORM = 3

#: Every pattern's matches hold one of these; most texts hold none and are passed at once.
HINT = rf"[0-9@]|[a-f]{{32}}|[A-F]{{32}}|AKIA|ghp_|sk-|{ADDRESS}"

#: Given names by gender and syllables of family names, by script.
GIVEN = {
    ("latin", "male"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Marc Nils Oscar Paul".split(),
    ("latin", "female"): "Ada Berta Clara Diana Emma Flora Greta Helen Ines Julia Klara Lena Maria Nora Olga Paula".split(),
    ("cyrillic", "male"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Марк Никита Олег Павел Роман Степан Юрий".split(),
    ("cyrillic", "female"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Софья Юлия".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mo na ne no pa ra re ro sa se ta te to".split(),
    "cyrillic": "ба бо ва во га да до за ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то фа хо".split(),
}


def mentions(text: Column) -> Column:
    """Every mention in a text, in order; none for a null text."""
    found = F.regexp_extract_all(text, F.lit(f"({PATTERN})"), F.lit(1))
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def type_of(mention: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed(TYPES[:-1]):
        kind = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def canonical(kind: Column, mention: Column) -> Column:
    digits = F.regexp_replace(mention, r"\D", "")
    return (
        F.when(kind.isin(*DIGITS), digits)
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "name", F.regexp_replace(mention, f"^{ADDRESS}", ""))
        .when((kind == NONE) | ((kind == "secret") & mention.rlike(SECRET_PREFIX)), mention)
        .otherwise(F.lower(mention))
    )


def gender_of(mention: Column) -> Column:
    """By the form of address; empty without one."""
    return (
        F.when(mention.rlike(rf"^(?:{MALE})\.? "), "male")
        .when(mention.rlike(rf"^(?:{FEMALE})\.? "), "female")
        .otherwise("")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _checked_kind(mention: Column) -> Column:
    """The type; an ungrouped number is a card only if its check digit is right."""
    return _let(
        type_of(mention),
        lambda kind: F.when(
            (kind == "card") & mention.rlike("^[0-9]+$") & (F.pmod(_luhn_sum(mention), F.lit(10)) != 0), F.lit(NONE)
        ).otherwise(kind),
    )


def _addressed_names(mentions: Column) -> Column:
    """The distinct (value, gender) of a document's names, in order of their first mention."""
    named = F.filter(mentions, lambda m: gender_of(m) != "")
    one = F.transform(named, lambda m: F.struct(canonical(F.lit("name"), m).alias("value"), gender_of(m).alias("gender")))
    return F.array_distinct(one)


def _pattern_with(names: Column) -> Column:
    """PATTERN, or else one of the names or of their words; longer ones first."""
    words = F.flatten(F.transform(names, lambda n: F.concat(F.array(n["value"]), F.split(n["value"], " "))))
    longest_first = F.reverse(F.array_sort(F.transform(F.array_distinct(words), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))))
    either = F.array_join(F.transform(longest_first, lambda w: w["w"]), "|")
    own = F.concat(F.lit(r"|(?<![\p{L}\p{M}-])(?:"), either, F.lit(r")(?![\p{L}\p{M}]|-\p{L})"))
    return F.concat(F.lit(PATTERN), F.when(F.size(names) > 0, own).otherwise(F.lit("")))


def _entity(mention: Column, names: Column) -> Column:
    """(mention, kind, value, gender, part) of a mention in a document with these names.

    A part of a fuller name of the document, of the same gender where a form of address tells
    one, is that person's: part is the place of its word. Of several persons it is the first.
    Names without a form of address belong to the first person so named.
    """

    def found(kind: Column, value: Column, gender: Column) -> Column:
        alike = F.filter(names, lambda n: (gender == "") | (n["gender"] == gender))
        whole = F.filter(alike, lambda n: n["value"] == value)
        fuller = F.filter(
            alike, lambda n: ~value.contains(" ") & n["value"].contains(" ") & F.array_contains(F.split(n["value"], " "), value)
        )
        person = F.when(kind == "name", F.coalesce(F.get(fuller, F.lit(0)), F.get(whole, F.lit(0))))
        return _let(
            person,
            lambda p: F.struct(
                mention.alias("mention"),
                kind.alias("kind"),
                F.coalesce(p["value"], value).alias("value"),
                F.coalesce(p["gender"], F.lit("")).alias("gender"),
                F.when(p["value"] != value, F.array_position(F.split(p["value"], " "), value).cast("int")).alias("part"),
            ),
        )

    return _let(_checked_kind(mention), lambda k: _let(canonical(k, mention), lambda v: found(k, v, gender_of(mention))))


def _number(digest: Column, place: Column | int, below: int) -> Column:
    """A number under `below` from 7 hex digits of the digest, which is read as a ring."""
    start = F.pmod(F.lit(place) * 7, F.lit(120)) + 1
    return F.pmod(F.conv(F.substring(digest, start, F.lit(7)), 16, 10).cast("long"), F.lit(below)).cast("int")


def _letter(digest: Column, place: Column, letters: str) -> Column:
    return F.substring(F.lit(letters), _number(digest, place, len(letters)) + 1, F.lit(1))


def _alike(value: Column, digest: Column, hexadecimal: bool = False) -> Column:
    """Digits for digits, letters for letters of the same case, everything else as it is."""
    lower = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"

    def other(c: Column, i: Column) -> Column:
        # Places beyond the digest's own draw from a digest of the place.
        ring = F.when(i < 17, digest).otherwise(F.sha2(F.concat(digest, i.cast("string")), 512))
        return (
            F.when(c.rlike("[0-9]"), _letter(ring, i, "0123456789"))
            .when(c.rlike("[a-z]"), _letter(ring, i, lower))
            .when(c.rlike("[A-Z]"), _letter(ring, i, lower.upper()))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), other), "")


def _luhn_sum(digits: Column) -> Column:
    """Of digits from right to left, every second one doubled, starting with the last but one."""
    backwards = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    worth = F.transform(
        backwards,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") * 2 / 10).cast("int")
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b)


def _card(value: Column, digest: Column) -> Column:
    """Another number of the same length and first digit, valid by its check digit if this one is."""
    other = F.concat(F.substring(value, 1, 1), F.expr("substring(drawn, 2)"))
    open_end = F.concat(F.substring(other, F.lit(1), F.length(other) - 1), F.lit("0"))
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(open_end), F.lit(10)), F.lit(10)).cast("string")
    return F.when(
        F.pmod(_luhn_sum(value), F.lit(10)) == 0,
        F.concat(F.substring(other, F.lit(1), F.length(other) - 1), check),
    ).otherwise(other)


def _email(value: Column, more: Column) -> Column:
    """Another local part and domain of the same shape, in a domain reserved for examples.

    `more` lengthens the local part.
    """
    ending = F.regexp_extract(value, r"\.(com|net|org)$", 1)
    local = F.substring_index("drawn", "@", 1)
    labels = F.split(F.substring_index("drawn", "@", -1), r"\.")
    sub = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    domain = F.concat(sub, F.array(F.lit("example"), F.when(ending != "", ending).otherwise(F.lit("org"))))
    return F.concat(local, more, F.lit("@"), F.array_join(domain, "."))


def _remainder_97(text: Column) -> Column:
    """Of the number that a text of digits and capitals stands for; A is 10, Z is 35."""

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, F.pmod(rest * 10 + code - 48, F.lit(97))).otherwise(
            F.pmod(rest * 100 + code - 55, F.lit(97))
        )

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _iban(value: Column) -> Column:
    """Another account of the same country, with right check digits."""
    country, account = F.substring(value, 1, 2), F.expr("substring(drawn, 5)")
    check = F.lit(98) - _remainder_97(F.concat(account, country, F.lit("00")))
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)


def _secret(value: Column, digest: Column) -> Column:
    """An issuer's prefix stays; what follows, or the whole of a hexadecimal one, is drawn."""
    prefix = F.regexp_extract(value, SECRET_PREFIX, 0)
    rest = F.regexp_replace(value, SECRET_PREFIX, "")
    return F.when(prefix != "", F.concat(prefix, _alike(rest, digest))).otherwise(
        _alike(value, digest, hexadecimal=True)
    )


def _ip(digest: Column) -> Column:
    return F.concat_ws(".", *(_number(digest, i, 254) + 1 for i in range(4)))


def _phone(value: Column, more: Column) -> Column:
    """The country code (what exceeds ten digits) stays; `more` lengthens the number."""
    code = F.greatest(F.length(value) - 10, F.lit(0))
    return F.concat(F.substring(value, F.lit(1), code), F.substring(F.col("drawn"), code + 1, F.length(value)), more)


def _name(value: Column, gender: Column, digest: Column) -> Column:
    """As many names as the mention has, of its script and the gender of its form of address."""
    script = F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def family(script_name: str) -> Column:
        syllables = F.array(*map(F.lit, SYLLABLES[script_name]))
        parts = [F.get(syllables, _number(digest, i, len(SYLLABLES[script_name]))) for i in range(1, 6)]
        return F.initcap(F.concat(*parts))

    def given(key: tuple[str, str]) -> Column:
        return F.get(F.array(*map(F.lit, GIVEN[key])), _number(digest, 0, len(GIVEN[key])))

    first = F.lit("")
    for (of_script, of_gender) in GIVEN:
        first = F.when((script == of_script) & (gender == of_gender), given((of_script, of_gender))).otherwise(first)
    last = F.when(script == "cyrillic", family("cyrillic")).otherwise(family("latin"))

    def middle(key: tuple[str, str]) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(F.split(value, " "))), lambda i: i < F.size(F.split(value, " ")) - 1)
        known = F.array(*map(F.lit, GIVEN[key]))
        return F.transform(places, lambda i: F.get(known, _number(digest, i + 6, len(GIVEN[key]))))

    between = F.array().cast("array<string>")
    for (of_script, of_gender) in GIVEN:
        between = F.when((script == of_script) & (gender == of_gender), middle((of_script, of_gender))).otherwise(between)
    whole = F.concat(F.array(first), between, F.array(last))
    return F.when(value.contains(" "), F.array_join(whole, " ")).otherwise(last)


def _syllables(value: Column, digest: Column, count: Column) -> Column:
    """So many more syllables of the script for the end of a family name."""

    def drawn(script: str) -> Column:
        known = F.array(*map(F.lit, SYLLABLES[script]))
        one = F.transform(F.sequence(F.lit(1), count), lambda i: F.get(known, _number(digest, i, len(SYLLABLES[script]))))
        return F.array_join(one, "")

    more = F.when(value.rlike(r"\p{IsCyrillic}"), drawn("cyrillic")).otherwise(drawn("latin"))
    return F.when(count > 0, more).otherwise(F.lit(""))


def _surrogate(entities: DataFrame, key: str) -> DataFrame:
    """entities (kind, value, gender, attempt) with a candidate surrogate."""
    kind, value = F.col("kind"), F.col("value")
    seed = F.concat_ws("|", F.lit(key), "kind", "value", "gender", F.col("attempt").cast("string"))
    drawn = entities.withColumn("digest", F.sha2(seed, 512)).withColumn(
        "drawn",
        F.when(kind == "secret", _secret(value, F.col("digest"))).otherwise(_alike(value, F.col("digest"))),
    )
    extra = F.sha2(F.concat_ws("|", seed, F.lit("more")), 512)
    grown = F.greatest(F.col("attempt") - SAME_FORM, F.lit(0))
    letters = F.substring(F.translate(extra, "0123456789", "ghijklmnop"), F.lit(1), grown)
    figures = F.substring(F.translate(extra, "abcdef", "012345"), F.lit(1), grown)
    candidate = (
        F.when(kind == "email", _email(value, letters))
        .when(kind == "ip", _ip(F.col("digest")))
        .when(kind == "card", _card(value, F.col("digest")))
        .when(kind == "iban", _iban(value))
        .when(kind == "phone", _phone(value, figures))
        .when(kind == "name", F.concat(_name(value, F.col("gender"), F.col("digest")), _syllables(value, extra, grown)))
        .otherwise(F.col("drawn"))
    )
    return drawn.withColumn("surrogate", candidate).drop("digest", "drawn")


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, value, gender, surrogate) for the distinct entities of found (kind, value, gender).

    No two entities of a kind get the same surrogate, and no surrogate is an entity of the
    corpus. Of entities that draw the same one the first by value and gender keeps it; the others and
    those that drew an entity draw again. Each round is written to the shared folder, and
    only entities that failed go on, a vanishing share from round to round. Forms of few
    surrogates (a one-letter local part has 26) may have none left: from the round after
    SAME_FORM on, addresses, phone numbers and names grow by a sign or syllable with every
    round. The shortest of the other forms, numbers of 9 digits and IP addresses, have a
    thousand million.
    """
    entities = stored(found.groupBy("kind", "value", "gender").agg(F.count("*").alias("n")).drop("n"), "entities")
    taken = entities.select("kind", F.col("value").alias("surrogate")).distinct()
    pending, settled, attempt = entities.withColumn("attempt", F.lit(0)), None, 0
    while True:
        used = taken.withColumn("used", F.lit(True)).hint("merge")  # grows with the corpus
        drawn = _surrogate(pending, key).join(used, ["kind", "surrogate"], "left")
        same = Window.partitionBy("kind", "surrogate").orderBy("value", "gender")
        good = F.col("used").isNull() & (F.row_number().over(same) == 1)
        tried = stored(drawn.withColumn("good", good).drop("used", "attempt"), "surrogates")
        fresh = tried.where("good").select("kind", "value", "gender", "surrogate")
        settled = fresh if settled is None else settled.unionByName(fresh)
        failed = tried.where("not good")
        if failed.isEmpty():
            return settled
        attempt += 1
        taken = taken.unionByName(fresh.select("kind", "surrogate"))
        pending = failed.select("kind", "value", "gender", F.lit(attempt).alias("attempt"))


def _written_like(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate with the mention's separators, or in its case; what it has more stands at the end."""
    start = F.struct(F.lit(1).alias("next"), F.lit("").alias("out"))

    def step(state: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            (state["next"] + digit.cast("int")).alias("next"),
            F.concat(state["out"], F.when(digit, F.substring(surrogate, state["next"], F.lit(1))).otherwise(c)).alias("out"),
        )

    def ended(state: Column) -> Column:
        return F.concat(state["out"], F.substring(surrogate, state["next"], F.length(surrogate)))

    spaced = F.aggregate(F.filter(F.split(mention, ""), lambda c: c != ""), start, step, ended)
    groups = F.trim(F.regexp_replace(surrogate, "(.{4})", "$1 "))
    return (
        F.when(kind.isin(*DIGITS), spaced)
        .when((kind == "iban") & mention.contains(" "), groups)
        .when(kind == "name", F.concat(F.regexp_extract(mention, f"^{ADDRESS}", 0), surrogate))
        .when((mention == F.upper(mention)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """`row` (all columns of docs), clean_text and n_mentions of every row.

    The same key gives the same surrogates for the same corpus. Texts are searched once and
    kept with what was found; those with a name are searched again for that name and its
    words, which takes time in proportion to the text and to the number of its names. Texts
    without a mention don't move; those with one meet their surrogates once. A null text
    stays null. Rows without doc_id and repeated rows are treated like any other. A person
    whom no form of address precedes in the document is not found.
    """
    identity = [F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("version")]
    read = stored(docs.select(*identity, F.struct("*").alias("row"), mentions(F.col("text")).alias("first")), "texts")
    some = F.coalesce(F.size("first"), F.lit(0)) > 0
    named = read.where(some).withColumn("names", _addressed_names(F.col("first")))
    text, pattern = F.col("row.text"), _pattern_with(F.col("names"))
    again = F.regexp_extract_all(text, F.concat(F.lit("("), pattern, F.lit(")")), F.lit(1))
    every = F.when(F.size("names") > 0, again).otherwise(F.col("first"))
    listed = _let(F.col("names"), lambda names: F.transform(every, lambda m: _entity(m, names)))
    found = stored(
        named.select("id", "version", "row", F.split(text, pattern, -1).alias("between"), listed.alias("listed")), "mentions"
    )
    places = found.select("id", "version", F.posexplode("listed").alias("place", "m")).select("id", "version", "place", "m.*")
    mapping = surrogates(places.where(F.col("kind") != NONE).select("kind", "value", "gender"), key)
    word = F.coalesce(F.get(F.split("surrogate", " "), F.col("part") - 1), F.col("surrogate"))
    written = F.coalesce(_written_like(F.col("mention"), F.col("kind"), word), F.col("mention")).alias("new")
    replaced = (
        places.join(mapping, ["kind", "value", "gender"], "left")
        .select("id", "version", F.struct("place", written).alias("mention"))
        .groupBy("id", "version")
        .agg(F.sort_array(F.collect_set("mention")).alias("new"))
    )
    new = F.concat(F.transform("new", lambda m: m["new"]), F.array(F.lit("")))
    clean = F.array_join(F.zip_with("between", new, lambda a, b: F.concat(a, b)), "")
    n = F.size(F.filter("listed", lambda m: m["kind"] != NONE)).cast("long")
    changed = found.join(replaced, ["id", "version"]).select("row", clean.alias("clean_text"), n.alias("n_mentions"))
    same = read.where(~some).select("row", F.col("row.text").alias("clean_text"), F.lit(0).cast("long").alias("n_mentions"))
    return same.unionByName(changed)
