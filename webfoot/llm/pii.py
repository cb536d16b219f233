"""Surrogates for personal data: keyed, type-consistent, distinct, and the same wherever an entity recurs.

Detected are e-mail addresses, telephone, card and bank numbers, IPv4
addresses, secrets, and names after a title.  Every entity gets a surrogate
from a keyed SHA-512 stream: digits become digits and letters letters of the
same case and script, so separators and length stay; a card number that passes
its check digit gets one that does too; an address stays an address; a domain
depends on the domain alone; a name keeps its title and gets a name of the
title's gender in the script of the original.

The surrogate is a function of key, kind, canonical form and an attempt
number, so an entity has one surrogate in all documents without any join.
Distinctness is checked over the whole corpus: entities are made distinct with
partial aggregation, and where two of one kind share a surrogate, or one is
itself an entity of the corpus, all but the first go on to the next attempt,
until nothing collides.  No format runs out of values and no attempt is the
last: a name that keeps colliding gets one more syllable with each attempt from
``NAME_ATTEMPTS`` on, anything else two more digits with each from
``FORMAT_ATTEMPTS`` on (an address before its ``@``, a telephone number as an
extension, an IPv4 address as a port).

Surnames are entities of their own and are settled first, against all surnames
of the corpus; then given names within them.  So a person named with and
without the given name keeps one surname, whatever collides, and two surnames
never become one.  Only entities with an attempt above 0 are joined back, by
the digest of the texts that hold them.

Only DataFrame functions are used.  A text without a digit, ``@``, title or
secret's prefix is never searched by the long pattern.

Scale: documents are read twice and their texts are not shuffled, only digests
and entities of the texts that hold any; the entity table holds one row per
distinct entity.  An entity in a third of all rows is one row after
partial aggregation.

Defined cases: null texts stay null, empty texts empty, both with no entity;
nulls in other columns and repeated rows pass through (equal texts stay equal);
an empty table gives an empty result; columns with the name of an added column
are replaced, any other name is allowed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfoot.llm.common import col, materialize, without

#: Key of the surrogates; a deployment passes its own.
DEFAULT_KEY = "surrogate-key-1"
NAME_ATTEMPTS = 4  # attempts with a name of the usual number of syllables
FORMAT_ATTEMPTS = 8  # attempts within the length of the original
BROADCAST_TEXTS = 50_000  # digests of texts to correct, and
BROADCAST_PLACES = 500_000  # places in them: some 20 MB together

#: Titles and the gender they tell.
MALE = "Mr|Mister|Sir|Herr|Herrn|Monsieur|Señor|Sr|господин|г-н|κύριος|κύριο"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|Sra|госпожа|г-жа|κυρία"
NEUTRAL = "Dr|Prof|Doctor|Professor|доктор"
SECRET_NAMES = "password|passwd|pwd|secret|token|api_key|api-key|apikey"

_L = r"\p{L}\p{N}"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_INITIALS = "MSHFDPгдκ"
_TITLE = rf"(?=[{_INITIALS}])(?<![{_L}])(?:{MALE}|{FEMALE}|{NEUTRAL})\.?"
PATTERNS = [
    rf"(?<![{_L}._%+-])[{_L}._%+-]++@[{_L}-]+(?:\.[{_L}-]+)+",
    rf"(?<=[=: \"'])(?<=(?i:{SECRET_NAMES})[ ]{{0,3}}[=:][ ]{{0,3}}[\"']{{0,1}})(?=[^\s\"']*\d)[A-Za-z0-9+/_.~=-]{{5,}}[A-Za-z0-9+/_~=-]",
    rf"(?<![{_L}])(?:AKIA|ASIA)[A-Z0-9]{{12,28}}(?![{_L}])",
    rf"(?<![{_L}])gh[pousr]_[A-Za-z0-9]{{30,60}}(?![{_L}])",
    r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    r"(?<![\d.-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?!\d|-\d)",
    rf"(?<![{_L}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_L}])",
    r"(?<!\d|\d-)\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    r"(?<!\d|\d[ .-])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)",
    r"(?<!\d|\d[.-])\d{3}([.-])\d{3}\2\d{4}(?!\d|[.-]\d)",
    rf"{_TITLE} {_NAME}(?: {_NAME})?",
]
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS)
#: Without any of these a text holds no entity (a secret after a keyword has a digit).  The look-ahead
#: spares the alternatives at nearly all places.
HINT = (rf"(?=[0-9@Ag{_INITIALS}])(?:[0-9@]|(?:{MALE}|{FEMALE}|{NEUTRAL})\.? \p{{Lu}}|A[KS]IA[A-Z]{{12}}"
        r"|gh[pousr]_[A-Za-z]{30})")

_LATIN = "abcdefghijklmnopqrstuvwxyz"
_CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"
_GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
SYLLABLES = {
    "latin": "ba bel bor da del dor fa fen gar hal jen ka kel lan len lor ma mel mor nar nel ra rin sal sen tal tor val".split(),
    "cyrillic": "ба бел бор да дел дор фа ген гар ка кел лан лен лор ма мел мор нар нел ра рин сал сен тал тор вал".split(),
    "greek": "βα βελ βορ δα δελ δορ φα φεν γαρ κα κελ λαν λεν λορ μα μελ μορ ναρ νελ ρα ριν σαλ σεν ταλ τορ βαλ".split(),
}
#: Endings of given names: (male, female).
ENDINGS = {"latin": ("o", "a"), "cyrillic": ("н", "на"), "greek": ("ος", "α")}


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def kind_of(value: Column) -> Column:
    return (F.when(value.rlike("@"), "email")
            .when(value.rlike(rf"^(?:{_TITLE}) "), "name")
            .when(value.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"), "ip")
            .when(value.rlike(r"^\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}$"), "card")
            .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "number")
            .when(value.rlike(r"^[+(0-9][-+(). 0-9]+$") & value.rlike(r"[-+(). ]"), "phone")
            .when(value.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]+$"), "number")
            .otherwise("secret"))


def canonical(kind: Column, value: Column) -> Column:
    """What makes two mentions the same entity."""
    digits = F.regexp_replace(value, r" x\d+$|\D", "")
    extension = F.regexp_extract(value, r" x\d+$", 0)  # surrogates only
    return (F.when(kind == "email", F.lower(value))
            .when(kind == "phone", F.concat(
                F.when(F.length(digits) >= 10, F.right(digits, F.lit(10))).otherwise(digits), extension))
            .when(kind == "card", digits)
            .when(kind == "number", F.replace(value, F.lit(" "), F.lit("")))
            .when(kind == "name", F.concat(_gender(value), F.lit(":"), F.lower(_bare_name(value))))
            .otherwise(value))


def _gender(value: Column) -> Column:
    return F.when(value.rlike(rf"^(?:{FEMALE})\.? "), "f").when(value.rlike(rf"^(?:{MALE})\.? "), "m").otherwise("n")


def _bare_name(value: Column) -> Column:
    return F.regexp_extract(value, rf"^[^ ]+ ({_NAME}(?: {_NAME})?)$", 1)


def _stream(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *parts), 512)


def _byte(stream: Column, i: Column) -> Column:
    """Number ``i`` (from 1; the stream of 64 repeats) as 0 to 255."""
    return F.conv(F.substring(stream, ((i - 1) % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))


def masked(text: Column, stream: Column) -> Column:
    """Each digit a digit, each letter one of its case and script, the rest as it is."""
    def one(i: Column) -> Column:
        c, n = F.substring(text, i, F.lit(1)), _byte(stream, i)
        return (F.when(c.rlike(r"\d"), _pick("0123456789", n))
                .when(c.rlike("[a-z]"), _pick(_LATIN, n)).when(c.rlike("[A-Z]"), F.upper(_pick(_LATIN, n)))
                .when(c.rlike(r"\p{IsCyrillic}"), _cased(c, _pick(_CYRILLIC, n)))
                .when(c.rlike(r"\p{IsGreek}"), _cased(c, _pick(_GREEK, n)))
                .when(c.rlike(r"\p{L}"), _cased(c, _pick(_LATIN, n))).otherwise(c))
    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")).otherwise(text)


def _cased(like: Column, letter: Column) -> Column:
    return F.when(like.rlike(r"\p{Lu}"), F.upper(letter)).otherwise(letter)


def masked_hex(text: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)),
                                    lambda i: _pick("0123456789abcdef", _byte(stream, i))), "")


def masked_digits(text: Column, stream: Column) -> Column:
    """Digits replaced by their place from the end, so that a longer form of a number agrees with a shorter."""
    def one(i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        left = F.length(F.regexp_replace(F.substring(text, i, F.length(text)), r"\D", ""))
        return F.when(c.rlike(r"\d") & (left <= 10), _pick("0123456789", _byte(stream, left))).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum, the last digit counted once."""
    n = F.length(digits)
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def masked_card(text: Column, canon: Column, stream: Column) -> Column:
    """The issuer's first digit stays; a valid check digit stays valid."""
    drawn = F.array_join(F.transform(F.sequence(F.lit(1), F.length(canon)), lambda i: F.when(
        i == 1, F.substring(canon, i, F.lit(1))).otherwise(_pick("0123456789", _byte(stream, i)))), "")
    body = lambda d: F.substring(d, F.lit(1), F.length(d) - 1)
    fixed = lambda d: F.when(luhn_sum(canon) % 10 == 0, F.concat(
        body(d), let(F.concat(body(d), F.lit("0")), lambda z: ((10 - luhn_sum(z) % 10) % 10).cast("string")))).otherwise(d)
    separator = F.regexp_extract(text, r"^\d{4}([ -]?)", 1)
    return let(drawn, lambda d: let(fixed(d), lambda f: F.concat_ws("", *[
        x for k in range(4) for x in ([separator] if k else []) + [F.substring(f, F.lit(4 * k + 1), F.lit(4))]])))


def _syllables(script: str, stream: Column, count: int, more: Column) -> Column:
    pool = F.array(*map(F.lit, SYLLABLES[script]))
    return F.initcap(F.concat(*[F.element_at(pool, _byte(stream, F.lit(1 + i)) % len(SYLLABLES[script]) + 1)
                                for i in range(count)], more))


def _more_syllables(name: Column, stream: Column, attempt: Column) -> Column:
    """Nothing, and from ``NAME_ATTEMPTS`` on one syllable more with each attempt."""
    pools = {k: F.array(*map(F.lit, v)) for k, v in SYLLABLES.items()}
    pool = F.when(name.rlike(r"^\p{IsCyrillic}"), pools["cyrillic"]).when(
        name.rlike(r"^\p{IsGreek}"), pools["greek"]).otherwise(pools["latin"])
    return F.when(attempt >= NAME_ATTEMPTS, F.array_join(F.transform(
        F.sequence(F.lit(1), attempt - (NAME_ATTEMPTS - 1)),
        lambda i: F.element_at(pool, _byte(stream, i + 3) % F.size(pool) + 1)), "")).otherwise("")


def _name_token(script: str, stream: Column, given: bool, gender: Column, more: Column) -> Column:
    if not given:
        name = _syllables(script, stream, 3, more)
        return F.when(gender == "f", F.concat(name, F.lit("а"))).otherwise(name) if script == "cyrillic" else name
    male, female = ENDINGS[script]
    return F.concat(_syllables(script, stream, 2, more), F.when(gender == "f", female).when(gender == "m", male).otherwise(""))


def _name_of(name: Column, given: bool, gender: Column, number: Column, key: str) -> Column:
    stream = _stream(key, F.lit("given" if given else "surname"), F.lower(name), number.cast("string"))
    return let(stream, lambda s: let(_more_syllables(name, s, number), lambda more: (
        F.when(name.rlike(r"^\p{IsCyrillic}"), _name_token("cyrillic", s, given, gender, more))
        .when(name.rlike(r"^\p{IsGreek}"), _name_token("greek", s, given, gender, more))
        .otherwise(_name_token("latin", s, given, gender, more)))))


def surname(value: Column) -> Column:
    return F.element_at(F.split(_bare_name(value), " "), -1)


def surname_forms(name: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogates of a surname: the plain one, and that of a woman where they differ."""
    return F.array_distinct(F.array(*[F.lower(_name_of(name, False, F.lit(g), attempt, key)) for g in "mf"]))


def masked_name(value: Column, attempt: Column, family: Column, key: str) -> Column:
    """The title, then for a given name (by ``attempt``) and a surname (by ``family``) one each, by gender and script."""
    gender, title, names = _gender(value), F.regexp_extract(value, r"^([^ ]+ )", 1), F.split(_bare_name(value), " ")
    given = F.concat(_name_of(F.element_at(names, 1), True, gender, attempt, key), F.lit(" "))
    return F.concat(title, F.when(F.size(names) > 1, given).otherwise(""), _name_of(
        F.element_at(names, -1), False, gender, family, key))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of one mention that is not a name."""
    local, domain = F.regexp_extract(value, "^([^@]*)", 1), F.regexp_extract(value, r"@(.*)\.[^.]*$", 1)
    ending = F.regexp_extract(value, r"(\.[^.]*)$", 1)
    def email(s: Column, more: Column) -> Column:
        return F.concat(let(local, lambda x: masked(x, s)), more, F.lit("@"), let(domain, lambda x: let(
            _stream(key, F.lit("domain"), F.lower(x)), lambda d: masked(x, d))), ending)
    def ip(s: Column) -> Column:
        return F.concat_ws(".", *[(_byte(s, F.lit(i)) % 254 + 1).cast("string") for i in range(1, 5)])
    def secret(s: Column) -> Column:
        head = F.regexp_extract(value, r"^((?:AKIA|ASIA|gh[pousr]_)?)", 1)
        rest = F.substring(value, F.length(head) + 1, F.length(value))
        return F.concat(head, let(rest, lambda x: F.when(x.rlike("^[0-9a-f]+$"), masked_hex(x, s)).otherwise(masked(x, s))))
    def longer(canon: Column) -> Column:
        """Nothing, and from ``FORMAT_ATTEMPTS`` on two digits more with each attempt."""
        return F.when(attempt >= FORMAT_ATTEMPTS, let(
            _stream(key, F.lit("longer"), kind, canon, attempt.cast("string")), lambda s: F.array_join(F.transform(
                F.sequence(F.lit(1), (attempt - (FORMAT_ATTEMPTS - 1)) * 2), lambda i: _pick("0123456789", _byte(s, i))),
                ""))).otherwise("")
    def after(mark: str, more: Column) -> Column:
        return F.when(more == "", "").otherwise(F.concat(F.lit(mark), more))
    def by_kind(canon: Column) -> Column:
        return let(_stream(key, kind, canon, attempt.cast("string")), lambda s: let(longer(canon), lambda more: (
            F.when(kind == "email", email(s, more))
            .when(kind == "phone", F.concat(masked_digits(value, s), after(" x", more)))
            .when(kind == "card", F.concat(masked_card(value, canon, s), after("-", more)))
            .when(kind == "ip", F.concat(ip(s), after(":", more)))
            .when(kind == "number", F.concat(masked(value, s), after("-", more)))
            .otherwise(F.concat(secret(s), more)))))
    return let(canonical(kind, value), by_kind)


def replacement(kind: Column, value: Column, attempt: Column, family: Column, key: str) -> Column:
    """The surrogate of one mention; ``family`` is the attempt of a name's surname."""
    return F.when(kind == "name", masked_name(value, attempt, family, key)).otherwise(surrogate(kind, value, attempt, key))


def mentions(text: Column) -> Column:
    """The entities of a text in order, as strings; none without a hint of one."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def found_entities(docs: DataFrame, text_col: str) -> DataFrame:
    """``(digest, found)`` of each distinct text with entities; their order is the text's."""
    text = col(text_col).cast("string")
    return (docs.select(text.alias("text")).where(F.col("text").rlike(HINT)).withColumn("found", mentions(F.col("text")))
            .where(F.size("found") > 0).select(F.sha2("text", 256).alias("digest"), "found")
            .groupBy("digest").agg(F.first("found").alias("found")))


def entity_table(found: DataFrame) -> DataFrame:
    """``(kind, canon, value)``: each distinct entity with one of its spellings."""
    return (found.select(F.explode("found").alias("value")).withColumn("kind", kind_of(F.col("value")))
            .withColumn("canon", canonical(F.col("kind"), F.col("value")))
            .groupBy("kind", "canon").agg(F.min("value").alias("value")))


def settle(entities: DataFrame, forms: Callable[[Column], Column]) -> DataFrame:
    """``entities`` (with ``kind, canon``) with the ``attempt`` at which nothing collides.

    ``forms`` gives the canonical forms of the surrogate at an attempt; the first tells entities apart, and none
    may be an entity of its kind.  ``entities`` is a written table.
    """
    kept = entities.columns
    tried = entities.withColumn("attempt", F.lit(0))
    while True:  # forms grow with the attempts, so this ends
        current = materialize(tried.select("kind", "canon", "attempt", forms(F.col("attempt")).alias("forms")).withColumn(
            "fake", F.get("forms", F.lit(0))), "fakes")  # planned and computed once
        first = current.groupBy("kind", "fake").agg(
            F.min_by("canon", F.struct("attempt", "canon")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = current.join(first, ["kind", "fake"]).where("canon <> first").select("kind", "canon")
        real = current.select("kind", "canon", F.explode("forms").alias("form")).join(
            tried.select("kind", F.col("canon").alias("form")), ["kind", "form"], "left_semi").select("kind", "canon")
        clash = materialize(shared.unionByName(real).distinct(), "clashes")
        if clash.isEmpty():
            return tried
        tried = materialize(tried.join(clash.withColumn("again", F.lit(1)), ["kind", "canon"], "left").select(
            *kept, (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")), "entities")


def settled(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, attempt, family)`` of the entities that need an attempt above 0: surnames first, then the rest."""
    named = materialize(entities.withColumn("surname", F.when(F.col("kind") == "name", surname(F.col("value")))), "named")
    surnames = materialize(named.where("surname is not null").groupBy(
        F.lit("surname").alias("kind"), F.lower("surname").alias("canon")).agg(F.min("surname").alias("value")), "surnames")
    families = settle(surnames, lambda n: surname_forms(F.col("value"), n, key)).where("attempt > 0").select(
        F.col("canon").alias("lower_surname"), F.col("attempt").alias("family"))
    whole = materialize(named.withColumn("lower_surname", F.lower("surname")).join(families, "lower_surname", "left").select(
        "kind", "canon", "value", F.coalesce("family", F.lit(0)).alias("family"),
        ((F.col("kind") == "name") & ~F.contains(F.split_part("canon", F.lit(":"), F.lit(-1)), F.lit(" "))).alias("lone")), "whole")
    # A lone surname is settled by now; no name with a given one can meet it.
    rest = settle(whole.where("not lone").drop("lone"), lambda n: F.array(canonical(F.col("kind"), replacement(
        F.col("kind"), F.col("value"), n, F.col("family"), key))))
    fixes = rest.drop("value").unionByName(whole.where("lone").select("kind", "canon", "family", F.lit(0).alias("attempt")))
    return fixes.where("attempt > 0 or family > 0").select("kind", "canon", "attempt", "family")


def replace_entities(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY,
                     length_col: str | None = None, add: bool = True) -> DataFrame:
    """``docs`` with the text's entities replaced and, with ``add``, ``n_entities`` and ``kinds`` added.

    ``length_col`` names a column that holds the text's length and follows it.
    """
    added = ["n_entities", "kinds"] if add else []
    kept = without(docs, added)
    found = materialize(found_entities(docs, text_col), "found")
    fixes = materialize(settled(entity_table(found), key), "fixes")
    # The caller's columns travel as one struct, so that no name clashes with those made here.
    rows = docs.select(F.struct(*map(col, kept)).alias("_wf_row"), col(text_col).cast("string").alias("_wf_text")).withColumn(
        "_wf_found", mentions(F.col("_wf_text")))
    none = F.struct(F.lit(0).alias("attempt"), F.lit(0).alias("family"))
    tries = F.transform("_wf_found", lambda v: none)
    if not fixes.isEmpty():
        digest = F.sha2(F.col("_wf_text"), 256)
        places = (found.select(F.col("digest").alias("_wf_key"), F.posexplode("found").alias("place", "value"))
                  .withColumn("kind", kind_of(F.col("value"))).withColumn("canon", canonical(F.col("kind"), F.col("value")))
                  .join(fixes, ["kind", "canon"]).groupBy("_wf_key")
                  .agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct("attempt", "family")))).alias("_wf_fix")))
        places = materialize(places, "fixed-texts")
        size = places.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("_wf_fix")).alias("places")).first()
        if size["texts"] <= BROADCAST_TEXTS and size["places"] <= BROADCAST_PLACES:
            places = F.broadcast(places)
        rows = rows.withColumn("_wf_key", F.when(F.size("_wf_found") > 0, digest)).join(places, "_wf_key", "left")
        tries = F.transform("_wf_found", lambda v, i: F.coalesce(F.element_at("_wf_fix", i), none))
    fakes = F.zip_with("_wf_found", tries, lambda v, n: let(kind_of(v), lambda k: replacement(
        k, v, n["attempt"], n["family"], key)))
    between = F.split("_wf_text", ENTITY, -1)
    joined = let(between, lambda parts: F.concat(F.array_join(F.zip_with(
        F.slice(parts, 1, F.size("_wf_found")), fakes, lambda a, b: F.concat(a, b)), ""), F.element_at(parts, -1)))
    text = F.when(F.size("_wf_found") > 0, joined).otherwise(F.col("_wf_text"))
    out = {c: F.col("_wf_row").getField(c) for c in kept} | {text_col: text}
    if add:
        out |= {"n_entities": F.size("_wf_found").cast("long"), "kinds": F.array_join(F.array_sort(
            F.array_distinct(F.transform("_wf_found", lambda v: kind_of(v)))), ",")}
    if length_col:
        out[length_col] = F.when(F.size("_wf_found") > 0, F.length(text)).otherwise(out[length_col]).cast(
            docs.schema[length_col].dataType)
    return rows.select(*[out[c].alias(c) for c in kept + added])
