"""PII replaced by surrogates: keyed, type-consistent, distinct and coreferent.

DataFrame functions only. One regular expression finds e-mail and IP addresses,
card, phone and social security numbers, IBANs, and names after a form of
address. A mention is reduced to its entities (kind and normal form), so differently
written mentions of one entity meet: lower case for addresses, letters and digits
only for numbers, and for names every word by itself. A name of one word is a surname;
of two words the first is a given name. So ``Mr John Smith`` and ``Mr Smith``
share the surrogate of the surname.

Every distinct entity of the whole corpus gets a surrogate derived from
sha-256 of (key, kind, attempt, entity): characters of the same class at the same
places; the first digit and the validity of the Luhn digit kept for cards; the
country kept for IBANs, with check digits that are valid (modulo 97) if the
entity's were; octets for IP addresses; an address of the same script at an example
domain for e-mail; and for names letters of the same script, marks in their places, given
names with an ending of the same gender where the script has one (Cyrillic surnames too).
The collision check groups the entities of all kinds by surrogate: if several share one,
or a surrogate is itself an entity of the corpus, all but the first get the
next attempt, until no collision is left. The space grows with the attempt, so it
cannot run out: a name gets one more letter for each attempt; from attempt ``GROW`` on,
numbers of fixed shape (social security, phone, card, IBAN) get one more character
for each attempt, and octets go up to 999, as the expression reads them.
So different entities stay different and no surrogate is a
real one; equal entities share one row, hence coreference. A mention takes its
entities' surrogates in its own layout (punctuation, capitals), further characters
at its end. The shape of a name or an address is that of its first ``SHAPE`` characters; all
of it counts for its identity.

Only mentions and entities are shuffled, plus the texts that hold a mention.

Defined cases: null text is empty; texts without a mention are returned as they
are; repeated rows get equal texts; null ids are kept; an empty table gives no rows;
of entities that tie for a surrogate the smallest (kind, entity) keeps it; every part of the
expression is possessive or of bounded length, so texts and mentions of any length are
matched without recursion; other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, id_text

GROW, SHAPE = 8, 64

_LOCAL = r"""[^\s@,;:=/<>()\[\]{}|"']"""
EMAIL = rf"(?<!{_LOCAL}){_LOCAL}++@[\p{{L}}\p{{N}}-]++(?:\.[\p{{L}}\p{{N}}-]++)++"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
PHONE = (r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}"
         r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])")
# Forms of address by gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Sra", "г-жа", "госпожа")
_TITLE = r"(?<!\p{L})(?:" + "|".join(MALE + FEMALE) + r")\.? "
_MARK = r"['’-]"
_WORD = rf"[\p{{Lu}}\p{{Lo}}](?:[\p{{L}}\p{{M}}'’-]++)"  # scripts without capitals: any letter
NAME = _TITLE + _WORD + rf"(?: {_WORD})?"
ENTITY = "|".join((EMAIL, IP, SSN, IBAN, CARD, PHONE, NAME))

# Small letters of scripts, from the first to the last code point, vowels apart
# in the scripts that write them as letters of their own.
_LATIN = ("aeiou", "bcdfghjklmnpqrstvwxz")
_CYRILLIC = ("аеиоу", "бвгдзклмнпрстфх")
_GREEK = ("αεηιου", "βγδζθκλμνξπρστφχψ")
_RANGES = {"Hebrew": (0x5D0, 0x5EA), "Arabic": (0x641, 0x64A), "Armenian": (0x561, 0x586), "Georgian": (0x10D0, 0x10F0),
           "Devanagari": (0x915, 0x939), "Thai": (0xE01, 0xE2E), "Hiragana": (0x304B, 0x3062), "Katakana": (0x30AB, 0x30C2),
           "Hangul": (0xAC00, 0xD7A3), "Han": (0x4E00, 0x9FA5)}
_ENDING = {"Latin": {"m": "n", "f": "a"}, "Cyrillic": {"m": "н", "f": "на"}, "Greek": {"m": "ος", "f": "α"}}


def may_hold(text: Column) -> Column:
    """False only for texts without any entity: a cheap test before ENTITY."""
    found = F.rlike(text, F.lit("[0-9@]"))
    for title in MALE + FEMALE:
        found = found | text.contains(title + " ") | text.contains(title + ". ")
    return found


def _full(pattern: str):
    return F.lit(f"^(?:{pattern})$")


def kind_of(mention: Column) -> Column:
    male = F.rlike(mention, F.lit("^(?:" + "|".join(MALE) + r")\.? "))
    return (F.when(mention.contains("@"), "email").when(F.rlike(mention, _full(IP)), "ip")
            .when(F.rlike(mention, _full(SSN)), "ssn").when(F.rlike(mention, _full(IBAN)), "iban")
            .when(F.rlike(mention, _full(CARD)), "card").when(F.rlike(mention, _full(PHONE)), "phone")
            .otherwise(F.when(male, "name:m").otherwise("name:f")))


def entities_of(mention: Column, kind: Column) -> Column:
    """Array of (kind, entity) of a mention: one, or a name's words."""
    words = F.split(F.lower(F.regexp_replace(mention, _TITLE, "")), " ")

    def word(w: Column, i: Column) -> Column:
        given = (F.size(words) == 2) & (i == 0)
        gendered = F.rlike(w, F.lit(r"^\p{IsCyrillic}"))
        role = F.when(given, F.concat(F.lit("given"), F.substring(kind, 5, 2))).otherwise(
            F.concat(F.lit("surname"), F.when(gendered, F.substring(kind, 5, 2)).otherwise("")))
        return F.struct(role.alias("kind"), w.alias("entity"))

    plain = F.when(kind.isin("email", "ip"), F.lower(mention)).otherwise(F.regexp_replace(mention, "[^0-9A-Za-z]", ""))
    return F.when(kind.startswith("name"), F.transform(words, word)).otherwise(
        F.array(F.struct(kind.alias("kind"), plain.alias("entity"))))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(c.cast("int"))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + b)


def _modulo_97(text: Column) -> Column:
    """Remainder of letters (as 10 to 35) and digits read as one number."""
    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(F.upper(c)) - 55
        return F.when(F.rlike(c, F.lit("[0-9]")), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint")), 4, "0")), "UTF-16BE")


def surrogate(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    """Normal form of the surrogate, a pure function of its arguments."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), entity)
    stream = F.concat(F.sha2(F.concat(F.lit("a|"), seed).cast("binary"), 256),
                      F.sha2(F.concat(F.lit("b|"), seed).cast("binary"), 256))

    def number(i: Column) -> Column:
        """0 to 65535, of a place in the stream that depends on ``i``; later turns are shifted."""
        return F.conv(F.substring(stream, (i * 4 + F.floor(i / 30).cast("int") * 7) % 120 + 1, F.lit(4)), 16, 10).cast("int")

    def letter_of(c: Column, i: Column) -> Column:
        """A small letter of the script of ``c``; marks and other characters stay."""
        def one_of(letters: str) -> Column:
            return F.substring(F.lit(letters), number(i) % len(letters) + 1, F.lit(1))

        out = F.when(F.rlike(c, F.lit(_MARK + r"|\P{L}")), c)
        for script, (vowels, others) in (("Latin", _LATIN), ("Cyrillic", _CYRILLIC), ("Greek", _GREEK)):
            out = out.when(F.rlike(c, F.lit("[" + vowels + "]")), one_of(vowels))
            out = out.when(F.rlike(c, F.lit(rf"\p{{Is{script}}}")), one_of(others))
        for script, (low, high) in _RANGES.items():
            out = out.when(F.rlike(c, F.lit(rf"\p{{Is{script}}}")), _code_point(number(i) % (high - low + 1) + low))
        return out.otherwise(one_of(_LATIN[1]))

    def same_class(c: Column, i: Column) -> Column:
        return (F.when(F.rlike(c, F.lit("[0-9]")), (number(i) % 10).cast("string"))
                .when(F.rlike(c, F.lit("[A-Z]")), F.char(number(i) % 26 + 65)).otherwise(letter_of(c, i)))

    def longer_by(n: Column, one) -> Column:
        """``n`` more characters, from places after the entity's own."""
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                                      lambda i: one(i + F.length(entity))), "")).otherwise("")

    grown = F.greatest(attempt - (GROW - 1), F.lit(0))
    more = longer_by(grown, lambda i: (number(i) % 10).cast("string"))
    shape = F.substring(entity, 1, SHAPE)
    shaped = F.concat(F.array_join(F.transform(F.split(shape, ""), same_class), ""), more)
    headed = F.concat(F.substring(entity, 1, 1), F.substring(shaped, F.lit(2), F.length(shaped)))
    body = F.substring(headed, F.lit(1), F.length(headed) - 1)
    check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(_luhn(entity) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(headed)
    country, account = F.substring(entity, 1, 2), F.substring(shaped, F.lit(5), F.length(shaped))
    valid = _modulo_97(F.concat(F.substring(entity, F.lit(5), F.length(entity)), F.substring(entity, 1, 4))) == 1
    digits = F.lpad((98 - _modulo_97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
    iban = F.concat(country, F.when(valid, digits).otherwise(F.substring(shaped, 3, 2)), account)
    local = F.array_join(F.transform(F.split(F.substring(F.substring_index(entity, "@", 1), 1, SHAPE), ""), same_class), "")
    email = F.concat(local, F.lit("@m"), F.substring(stream, 105, 12), F.lit(".example.net"))
    ip = F.array_join(F.transform(F.array(*[F.lit(i) for i in range(4)]),
                                  lambda i: F.when(grown == 0, number(i) % 254 + 1).otherwise(
                                      number(i) % 1000).cast("string")), ".")

    first = F.regexp_extract(entity, r"(\p{L})", 1)
    name = F.concat(F.array_join(F.transform(F.split(shape, ""), letter_of), ""), longer_by(attempt, lambda i: letter_of(first, i)))
    ending = F.lit("")
    for script, of_gender in _ENDING.items():
        for gender, letters in of_gender.items():
            ending = F.when(F.rlike(first, F.lit(rf"\p{{Is{script}}}")) & kind.endswith(":" + gender), letters).otherwise(ending)

    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "iban", iban)
            .when(kind == "phone", headed).when(kind.startswith("given") | kind.startswith("surname"), F.concat(name, ending))
            .otherwise(shaped))


def laid_out(mention: Column, kind: Column, new: Column) -> Column:
    """The surrogates (an array) in the layout of the mention."""
    one = F.get(new, F.lit(0))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    chars = F.aggregate(
        F.split(mention, ""), start,
        lambda s, c: F.when(F.rlike(c, F.lit("[0-9A-Za-z]")), F.struct(
            F.concat(s["text"], F.substring(one, s["at"] + 1, F.lit(1))).alias("text"), (s["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(s["text"], c).alias("text"), s["at"].alias("at"))),
        lambda s: F.concat(s["text"], F.substring(one, s["at"] + 1, F.length(one))))
    title = F.regexp_extract(mention, f"^({_TITLE})", 1)
    words = F.split(F.regexp_replace(mention, _TITLE, ""), " ")

    def cased(word: Column, plain: Column) -> Column:
        """Capitals at the places where the mention has them; all capitals stay so."""
        at_places = F.array_join(F.transform(F.split(plain, ""), lambda c, i: F.when(
            F.rlike(F.substring(word, i + 1, F.lit(1)), F.lit(r"\p{Lu}")), F.upper(c)).otherwise(c)), "")
        return F.when(word == F.upper(word), F.upper(plain)).otherwise(at_places)

    name = F.concat(title, F.array_join(F.zip_with(words, new, cased), " "))
    return F.when(kind.isin("email", "ip"), one).when(kind.startswith("name"), name).otherwise(chars)


def surrogate_table(entities: DataFrame, key: str, generate=surrogate) -> DataFrame:
    """(kind, entity, attempt, new) of distinct (kind, entity) rows: no two
    entities share ``new``, and none is an entity itself, of whatever kind."""
    entities = cut(entities)
    table = cut(entities.withColumn("attempt", F.lit(0))
                .withColumn("new", generate(F.col("kind"), F.col("entity"), F.col("attempt"), key)))
    real = entities.select(F.col("entity").alias("new"), F.lit(True).alias("real")).distinct()
    while True:
        first = table.groupBy("new").agg(F.min(F.struct("attempt", "kind", "entity")).alias("first"))
        judged = table.join(first, "new").join(real, "new", "left").withColumn(
            "clash", F.col("real").isNotNull() | (F.col("first") != F.struct("attempt", "kind", "entity")))
        table = cut(judged.select("kind", "entity", "clash", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"), "new")
                    .withColumn("new", F.when(F.col("clash"), generate(
                        F.col("kind"), F.col("entity"), F.col("attempt"), key)).otherwise(F.col("new"))))
        if table.where("clash").isEmpty():
            return table.drop("clash")


def replace_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     key: str = "surrogates") -> DataFrame:
    """One row per row of ``docs``: id, text with surrogates, n_entities (mentions)
    and kinds (distinct, sorted, comma-joined)."""
    rows = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    has = F.when(may_hold(F.col("text")), F.rlike("text", F.lit(ENTITY))).otherwise(F.lit(False))
    marked = rows.where(has)
    mentions = cut(marked.select("id", "row", F.posexplode(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
                                 .alias("place", "mention")).distinct()
                   .withColumn("kind", kind_of(F.col("mention")))
                   .withColumn("entities", entities_of(F.col("mention"), F.col("kind"))))
    spread = mentions.select("id", "row", "place", "mention", F.col("kind").alias("of_kind"),
                             F.posexplode("entities").alias("word", "entity")).select("*", "entity.kind", F.col("entity.entity").alias("plain"))
    table = surrogate_table(spread.select("kind", F.col("plain").alias("entity")).distinct(), key).select(
        "kind", F.col("entity").alias("plain"), "new")
    whole = spread.join(table, ["kind", "plain"]).groupBy("id", "row", "place", "mention", "of_kind").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "new"))), lambda w: w["new"]).alias("new"))
    done = (whole.select("id", "row", F.struct("place", laid_out(F.col("mention"), F.col("of_kind"), F.col("new")).alias("new"),
                                               F.substring_index("of_kind", ":", 1).alias("kind")).alias("mention"))
            .groupBy(F.col("id").alias("of"), F.col("row").alias("of_row")).agg(F.array_sort(F.collect_list("mention")).alias("found")))
    pieces = F.zip_with(F.split("text", ENTITY, -1), F.col("found.new"), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    changed = (marked.join(done, marked["id"].eqNullSafe(done["of"]) & (marked["row"] == done["of_row"]))
               .select("id", F.array_join(pieces, "").alias("text"), F.size("found").alias("n_entities"),
                       F.array_join(F.array_sort(F.array_distinct("found.kind")), ",").alias("kinds")))
    same = rows.where(~has).select("id", "text", F.lit(0).alias("n_entities"), F.lit("").alias("kinds"))
    return changed.unionByName(same).withColumnRenamed("id", id_col)
