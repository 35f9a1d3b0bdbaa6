"""PII surrogate generation with DataFrame functions only.

A pattern finds mentions of entities in every text. A mention is reduced to its entity (type and
canonical form), so that all mentions of one entity, however written, share a surrogate. Each
distinct entity gets a keyed surrogate of its type: digits for digits, letters of the same script for
letters, addresses that are valid, card numbers that keep their checksum, names of the same gender
and script. Collision rounds follow: a surrogate that another entity has already, or that occurs as
an entity in the corpus, is drawn again until all are distinct; a crowded format grows in later rounds, so
that they end. Family names are entities, shared by all who bear them; a given name is an entity of its family, with
its gender. Then each mention is replaced in its own format. Only texts with a mention take part in the
join that brings the surrogates back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.sources.workspace import stored

GROW = 4  # rounds in a format as it is; each later one adds a sign

# Forms of address by gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа")
NEUTRAL = ("Dr", "Prof")
#: Given names by gender and script, from which surrogates are drawn.
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Colin", "Daniel", "Erik", "Felix", "Henry", "Ivan", "Jonas", "Karl", "Liam", "Martin"),
    ("f", "latin"): ("Anna", "Bella", "Clara", "Diana", "Emma", "Flora", "Helen", "Irene", "Julia", "Laura", "Maria", "Nora"),
    ("n", "latin"): ("Alex", "Charlie", "Jamie", "Jordan", "Kim", "Robin", "Sam", "Taylor"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Максим"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Ирина", "Мария"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя", "Слава"),
}
SYLLABLES = {
    "latin": ("bar", "ben", "cor", "dal", "den", "far", "gar", "hol", "kan", "lan", "mor", "nor", "pel", "ros", "sol", "tan"),
    "cyrillic": ("бар", "вол", "гор", "дан", "жел", "зар", "кан", "лав", "мор", "нов", "пол", "рам", "сол", "тар", "фед", "чер"),
}

_TITLES = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
#: Types in the order in which they are tried. A value is taken to its end, however long; a secret does
#: not end in a full stop, nor take the first part of a mail address.
PATTERNS: Mapping[str, str] = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){1,126}",
    "secret": r"\b(?i:token|api[_-]?key|secret|password)\s{0,3}[=:]\s{0,3}[\"']?(?![\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++\.)[A-Za-z0-9_/+.=~-]{7,}[A-Za-z0-9_/+=~-]",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]{0,2}\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "national": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": r"(?<!\d)(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)",
    "name": rf"\b(?:{_TITLES})\b\.? \p{{Lu}}\p{{Ll}}++(?: \p{{Lu}}\p{{Ll}}++)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What no text without a mention of these types can do without.
HINT = rf"[@\p{{Nd}}]|\b(?:{_TITLES})\b|(?i:token|key|secret|password)"


def _type(mention: Column) -> Column:
    out = F.lit("name")
    for name, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"[^0-9]", "")


_SECRET_HEAD = r"^(?i:token|api[_-]?key|secret|password)\s{0,3}[=:]\s{0,3}[\"']?"
_NAME_HEAD = rf"^(?:{_TITLES})\b\.? "


def _gender(mention: Column) -> Column:
    of = lambda titles: mention.rlike(rf"^(?:{'|'.join(titles)})\b")
    return F.when(of(MALE), "m").when(of(FEMALE), "f").otherwise("n")


def _entity(kind: Column, mention: Column) -> Column:
    """The canonical form. A name is known by its family name, a phone by its last ten digits."""
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "secret", F.regexp_replace(mention, _SECRET_HEAD, ""))
        .when(kind.isin("card", "national"), _digits(mention))
        .when(kind == "phone", F.right(_digits(mention), F.lit(10)))
        .when(kind == "name", F.lower(F.regexp_extract(mention, r"(\p{L}+)$", 1)))
        .otherwise(mention)
    )


def _given(mention: Column) -> Column:
    return F.lower(F.regexp_extract(mention, rf"{_NAME_HEAD}(\p{{L}}+) \p{{L}}+$", 1))


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, idx, mention, kind, entity, given, gender): every mention of every distinct text.

    ``mark`` is a hash of the text and tells rows with one doc_id apart. ``given`` is empty where no given
    name stands before the family name.
    """
    hinted = docs.filter(F.col("text").rlike(HINT)).select(
        F.col("doc_id"), F.xxhash64("text").alias("mark"), F.regexp_extract_all("text", F.lit(ANY), 0).alias("found")
    )
    each = hinted.filter(F.size("found") > 0).select("doc_id", "mark", F.posexplode("found").alias("idx", "mention"))
    kinds = each.withColumn("kind", _type(F.col("mention"))).withColumn("entity", _entity(F.col("kind"), F.col("mention")))
    named = F.col("kind") == "name"
    return kinds.withColumns({
        "given": F.when(named, _given(F.col("mention"))).otherwise(""),
        "gender": F.when(named, _gender(F.col("mention"))).otherwise(""),
    })


def persons(found: DataFrame) -> DataFrame:
    """(entity, given, gender, person): the person whom a title, given and family name mean.

    A title without a gender means the man, or the woman, of that name if only one of them occurs.
    """
    of = lambda gender: F.bool_or(F.col("gender") == gender)
    names = found.filter(F.col("given") != "").groupBy("entity", "given").agg(of("m").alias("m"), of("f").alias("f"), of("n").alias("n"))
    neutral = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("n")
    means = [(F.col("m"), "m", F.lit("m")), (F.col("f"), "f", F.lit("f")), (F.col("n"), "n", neutral)]
    each = F.filter(F.array(*[F.when(here, F.struct(F.lit(g).alias("gender"), who.alias("who"))) for here, g, who in means]), F.isnotnull)
    return names.select("entity", "given", F.inline(each)).select(
        "entity", "given", "gender", F.concat_ws("|", "entity", "given", "who").alias("person")
    )


def _number(key: str, attempt: Column, *of: Column) -> Column:
    """A keyed number below 2**60."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.col("kind"), F.col("entity"), attempt.cast("string"), *of), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _pick(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), (number % len(alphabet) + 1).cast("int"), F.lit(1))


def _letterwise(key: str, attempt: Column, value: Column) -> Column:
    """Each letter and digit replaced by a keyed one of its class and script; other signs stay."""
    hexa = value.rlike(r"^[0-9a-f]+$")

    def one(char: Column, i: Column) -> Column:
        n = _number(key, attempt, i.cast("string"))
        return (
            F.when(hexa, _pick("0123456789abcdef", n))
            .when(char.rlike("[0-9]"), _pick("0123456789", n))
            .when(char.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", n))
            .when(char.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .when(char.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшэюя", n))
            .when(char.rlike(r"\p{IsGreek}"), _pick("αβγδεζηθικλμνξοπρστυφχψω", n))
            .when(char.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", n))
            .otherwise(char)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _grown(key: str, attempt: Column, alphabet: str) -> Column:
    """Further signs for a crowded format: none in the first rounds, then one more in each."""
    steps = F.sequence(F.lit(1), F.greatest(attempt - GROW + 1, F.lit(1)))
    signs = F.array_join(F.transform(steps, lambda i: _pick(alphabet, _number(key, attempt, F.lit("more"), i.cast("string")))), "")
    return F.when(attempt >= GROW, signs).otherwise("")


def _checksum(number: Column) -> Column:
    """Luhn's sum of a string of digits, modulo 10."""
    chars = F.reverse(F.split(number, ""))
    one = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))
    return F.aggregate(F.transform(chars, one), F.lit(0), lambda a, x: a + x.cast("int")) % 10


def _card(key: str, attempt: Column, value: Column) -> Column:
    """The same first digit and, where the number had a valid checksum, a valid one again."""
    drawn = F.concat(F.substring(value, 1, 1), F.substring(_letterwise_digits(key, attempt, value), F.lit(2), F.length(value)), _grown(key, attempt, "0123456789"))
    stem = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    fixed = F.concat(stem, ((10 - _checksum(F.concat(stem, F.lit("0")))) % 10).cast("string"))
    return F.when(_checksum(value) == 0, fixed).otherwise(drawn)


def _letterwise_digits(key: str, attempt: Column, value: Column) -> Column:
    return F.array_join(
        F.transform(F.split(value, ""), lambda c, i: (_number(key, attempt, i.cast("string")) % F.when(i == 0, 8).otherwise(10) + F.when(i == 0, 1).otherwise(0)).cast("string")), ""
    )


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _family(key: str, attempt: Column, value: Column) -> Column:
    """Three syllables of the script, 16 of each, and one more in each later round."""

    def built(script: str) -> Column:
        parts = F.array(*map(F.lit, SYLLABLES[script]))
        steps = F.sequence(F.lit(1), (F.lit(3) + attempt).cast("int"))
        return F.array_join(F.transform(steps, lambda i: F.element_at(parts, (_number(key, attempt, i.cast("string")) % 16 + 1).cast("int"))), "")

    return F.when(_script(value) == "cyrillic", built("cyrillic")).otherwise(built("latin"))


def _given_name(key: str, attempt: Column, value: Column) -> Column:
    """family|name for a person (family|given|gender): a name of the gender and script; from the third round on
    syllables are added, one more in each."""
    parts = F.split(value, r"\|")
    given, gender, n = parts[1], parts[2], _number(key, attempt, F.lit("given"))
    steps = F.sequence(F.lit(1), F.greatest(attempt - 1, F.lit(1)))
    name = F.lit("")
    for (whose, script), names in GIVEN.items():
        of = F.array(*map(F.lit, SYLLABLES[script]))
        more = F.array_join(F.transform(steps, lambda i: F.element_at(of, (_number(key, attempt, i.cast("string")) % 16 + 1).cast("int"))), "")
        drawn = F.concat(F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int")), F.when(attempt >= 2, more).otherwise(""))
        name = F.when((gender == whose) & (_script(given) == script), drawn).otherwise(name)
    return F.concat(parts[0], F.lit("|"), name)


def _drawn(key: str, attempt: Column) -> Column:
    kind, value = F.col("kind"), F.col("entity")
    octets = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_number(key, attempt, i.cast("string")) % 223 + 1).cast("string")), ".")
    # A mail address keeps its last label.
    head, tail = F.regexp_extract(value, r"^(.*)(\.[^.]*)$", 1), F.regexp_extract(value, r"^(.*)(\.[^.]*)$", 2)
    return (
        F.when(kind == "email", F.concat(_grown(key, attempt, "abcdefghijklmnopqrstuvwxyz"), _letterwise(key, attempt, head), tail))
        .when(kind == "secret", F.concat(_letterwise(key, attempt, value), _grown(key, attempt, "0123456789abcdef")))
        .when(kind == "ip", F.concat(octets, F.when(attempt >= GROW, ":").otherwise(""), _grown(key, attempt, "123456789")))
        .when(kind == "card", _card(key, attempt, value))
        .when(kind == "name", _family(key, attempt, value))
        .when(kind == "given", _given_name(key, attempt, value))
        .otherwise(F.concat(_letterwise_digits(key, attempt, value), _grown(key, attempt, "0123456789")))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity) rows: distinct surrogates per kind, none of
    which is an entity itself. The result depends on the key and the entities alone.

    Where a format cannot tell its entities apart, later rounds lengthen it: a mail address by letters in front, an
    address by a port, other values by signs at the end.
    """
    entities = stored(entities, "entities")
    real = entities.select(F.col("kind").alias("_kind"), F.col("entity").alias("_real"))
    open_, settled, attempt = entities, None, 0
    while True:
        drawn = open_.withColumn("surrogate", _drawn(key, F.lit(attempt)))
        drawn = drawn.join(real, (F.col("kind") == F.col("_kind")) & (F.col("surrogate") == F.col("_real")), "left")
        if settled is not None:
            taken = settled.select(F.col("kind").alias("_k"), F.col("surrogate").alias("_taken")).distinct()
            drawn = drawn.join(taken, (F.col("kind") == F.col("_k")) & (F.col("surrogate") == F.col("_taken")), "left")
        else:
            drawn = drawn.withColumn("_taken", F.lit(None).cast("string"))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("entity")) == 1
        good = F.col("_real").isNull() & F.col("_taken").isNull() & first
        judged = stored(drawn.select("kind", "entity", "surrogate", good.alias("good")), "drawn")
        new = judged.filter("good").select("kind", "entity", "surrogate")
        settled = new if settled is None else settled.unionByName(new)
        open_ = judged.filter(~F.col("good")).select("kind", "entity")
        if open_.isEmpty():
            return settled
        attempt += 1


def _rendered(given: Column) -> Column:
    """The surrogate in the mention's own format; signs by which it is longer follow at the end."""
    mention, sur, kind = F.col("mention"), F.col("surrogate"), F.col("kind")
    count = F.length(_digits(mention))
    extra = F.greatest(count - F.length(sur), F.lit(0))  # a phone's country code stays

    def digit(char: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(mention, F.lit(1), i + 1)))
        return F.when(char.rlike("[0-9]") & (nth > extra), F.substring(sur, nth - extra, F.lit(1))).otherwise(char)

    numbers = F.array_join(F.transform(F.split(mention, ""), digit), "")
    numbers = F.concat(numbers, F.substring(sur, count - extra + 1, F.length(sur)))
    name = F.concat(F.regexp_extract(mention, _NAME_HEAD, 0), F.when(given != "", F.concat(F.initcap(given), F.lit(" "))).otherwise(""), F.initcap(sur))
    return (
        F.when(kind == "email", F.when(mention == F.upper(mention), F.upper(sur)).otherwise(sur))
        .when(kind == "secret", F.concat(F.regexp_extract(mention, _SECRET_HEAD, 0), sur))
        .when(kind == "ip", sur)
        .when(kind == "name", name)
        .otherwise(numbers)
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, text with surrogates, n_replaced.

    A null text stays null, and a text without a mention stays as it is. Repeated rows each get a row
    with the same text. The same entity has the same surrogate in all documents; different ones
    have different ones, persons of one family included. However many entities share a format, all are
    replaced. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(mentions(rows).dropDuplicates(["doc_id", "mark", "idx"]), "mentions")
    who = stored(persons(found), "persons")
    all_ = found.select("kind", "entity").union(who.select(F.lit("given"), "person"))
    known = stored(surrogates(all_.distinct(), key), "surrogates")
    names = known.filter(F.col("kind") == "given").select(F.col("entity").alias("person"), F.substring_index("surrogate", "|", -1).alias("drawn"))
    names = who.join(names, "person").select(F.lit("name").alias("kind"), "entity", "given", "gender", "drawn")
    at = ["doc_id", "mark", "idx"]
    full = found.filter(F.col("given") != "").join(known, ["kind", "entity"]).join(names, ["kind", "entity", "given", "gender"])
    rest = found.filter(F.col("given") == "").join(known, ["kind", "entity"])
    replaced = full.select(*at, _rendered(F.col("drawn")).alias("new")).union(rest.select(*at, _rendered(F.lit("")).alias("new")))
    lists = replaced.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("idx", "new"))).alias("_new"))  # of one text
    lists = stored(lists, "replacements").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "_new")
    has = F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(ANY), F.lit(False))
    plain = rows.filter(~has).select("doc_id", "text", F.lit(0).cast("long").alias("n_replaced"))
    marked = rows.filter(has).withColumn("mark", F.xxhash64("text"))
    joined = marked.join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    gaps = F.split("text", ANY, -1)
    new = F.concat(F.col("_new.new"), F.array(F.lit("")))
    text = F.array_join(F.zip_with(gaps, new, lambda g, n: F.concat(g, n)), "")
    return plain.unionByName(joined.select("doc_id", text.alias("text"), F.size("_new").cast("long").alias("n_replaced")))
