"""Personal data replaced by surrogates, with DataFrame functions only.

Detected entities are reduced to a canonical form (the digits of a phone number, the
lower case of an address), so that one person's data has one surrogate however it
is written. The corpus' distinct canonical forms draw surrogates by a keyed hash:
same kind, same format; names keep script and gender. A draw is refused if another
form of its kind drew the same, or if it equals a real one of the corpus; refused
forms draw again, after some draws with more characters, until all are distinct. So distinct entities stay
distinct and equal ones equal, in and across documents. Last, each occurrence is
written in its own format.

Only texts with a digit, an at sign or a form of address are searched, only those
with entities are joined with their replacements, and all others pass unchanged
without a shuffle. Texts that are equal share one row there.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import new_folder

# Forms of address with the gender they tell, and common names.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Frau", "Madame", "Señora", "Госпожа")
FIRST_NAMES = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Leo", "Max"),
    ("latin", "f"): ("Anna", "Berta", "Clara", "Dora", "Emma", "Frida", "Ida", "Julia", "Lea", "Nina"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Илья", "Лев"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Жанна", "Инна", "Лидия", "Нина"),
}
SYLLABLES = {
    "latin": ("ba", "do", "fe", "gu", "ka", "lo", "mi", "ne", "po", "ra", "se", "ti", "va", "wo"),
    "cyrillic": ("ба", "до", "ве", "гу", "ка", "ло", "ми", "не", "по", "ра", "се", "ти", "ва"),
}
# End of fixed values.

_TITLES = "|".join(sorted(MALE_TITLES + FEMALE_TITLES, key=len, reverse=True))
_LOCAL = r"\p{L}\p{N}._%+-"
#: A capital word, also of parts that are joined, each with a capital.
_NAME = r"(?!\p{Lu}(?![\p{L}'’-]))\p{Lu}\p{L}*+(?:['’-]\p{Lu}\p{L}*+)*+"
#: Such a word, or an initial before another one.
_NAMES = rf"(?:{_NAME}|\p{{Lu}}\.(?= \p{{Lu}}))"
#: Kinds in the order in which they are tried. Every pattern is linear: a run is
#: entered at its start only, or all its repetitions are bounded.
PATTERNS = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++@[\p{{L}}0-9-]++(?:\.[\p{{L}}0-9-]++)+",
    "key": r"(?<![0-9A-Za-z])(?:AKIA|ASIA)[A-Z0-9]{16}(?![0-9A-Za-z])",
    "password": r"(?i:password|passwd|pwd)[\"']? ?[=:] ?[\"']?[^\s\"',;|]{4,}+",
    "hex": r"(?<![0-9A-Za-z])[0-9a-f]{32,}+(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "phone": r"\+\d{1,3}[ -]?\(?\d{1,4}\)?(?:[ -]?\d{2,4}){2,4}(?!\d)"
    r"|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
    r"|(?<![\d.])\d{3}\.\d{3}\.\d{4}(?!\.?\d)|(?<![\d.,/-])0\d{2,4}[/-]\d{5,8}(?![\d/-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "card": r"(?<![\d-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?![\d-])",
    "name": rf"(?<!\p{{L}})(?:{_TITLES})\.? {_NAMES}(?: {_NAMES})*+",
}
ENTITY = "|".join(PATTERNS.values())
_SECRET_PREFIX = r"^(?i:password|passwd|pwd)[\"']? ?[=:] ?[\"']?"
#: Draws in an entity's own format; each later one is a character longer than the one before.
OWN_FORMAT = 8


def _stored(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def suspicious(text: Column) -> Column:
    """Whether a text can hold an entity at all."""
    titles = [text.contains(title) for title in MALE_TITLES + FEMALE_TITLES]
    return F.coalesce(reduce(Column.__or__, [text.rlike("[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd)|[0-9a-f]{32}"), *titles]), F.lit(False))


def entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern fits the whole entity."""
    first, *rest = PATTERNS.items()
    out = F.when(entity.rlike(f"^(?:{first[1]})$"), first[0])
    for kind, pattern in rest:
        out = out.when(entity.rlike(f"^(?:{pattern})$"), kind)
    return out


def script_of(entity: Column) -> Column:
    return F.when(entity.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def canonical(kind: Column, entity: Column) -> Column:
    """What all spellings of an entity share; a name's is its last word, with its script.

    First names have a form of their own, see ``first_name``.
    """
    digits = F.regexp_replace(entity, "[^0-9+]", "")
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind.isin("phone", "ssn", "card"), digits)
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "password", F.regexp_replace(entity, _SECRET_PREFIX, ""))
        .when(
            kind == "name",
            F.concat(script_of(entity), F.lit(" "), F.lower(F.element_at(F.split(entity, " "), -1))),
        )
        .otherwise(entity)
    )


def _female(entity: Column) -> Column:
    title = F.regexp_replace(F.get(F.split(entity, " "), F.lit(0)), r"\.", "")
    return title.isin(*FEMALE_TITLES)


def first_name(entity: Column) -> Column:
    """The form of a name's first name, "script gender family first"; null if it has none."""
    words = F.split(F.lower(entity), " ")
    gender = F.when(_female(entity), "f").otherwise("m")
    form = F.concat_ws(" ", script_of(entity), gender, F.element_at(words, -1), F.get(words, F.lit(1)))
    return F.when(F.size(words) > 2, form)


def _number(noise: Column, at: Column, below: int) -> Column:
    """A number below ``below`` from four hexadecimal digits of ``noise``."""
    place = 4 * F.pmod(at, F.lit(30)) + 1
    return F.pmod(F.conv(F.substring(noise, place, F.lit(4)), 16, 10).cast("int"), F.lit(below))


def _filled(pattern: Column, noise: Column) -> Column:
    """``pattern`` with every letter and digit drawn anew, in its case."""

    def drawn(letter: Column, at: Column) -> Column:
        return (
            F.when(letter.rlike("^[0-9]$"), _number(noise, at, 10).cast("string"))
            .when(letter.rlike(r"^\p{Lu}$"), F.char(65 + _number(noise, at, 26)))
            .when(letter.rlike(r"^\p{L}$"), F.char(97 + _number(noise, at, 26)))
            .otherwise(letter)
        )

    return F.array_join(F.transform(F.split(pattern, ""), drawn), "")


def _chosen(values, noise: Column, at: int) -> Column:
    drawn = _number(noise, F.lit(at), len(values))
    return F.element_at(F.array(*map(F.lit, values)), drawn + 1)


def draw(kind: Column, form: Column, key: str, attempt: int) -> Column:
    """A surrogate for a canonical form; the same for the same key and attempt."""
    seed = F.concat_ws("|", F.lit(key), kind, form, F.lit(str(attempt)))
    noise = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("+")), 256))
    local, domain = F.substring_index(form, "@", 1), F.substring_index(form, "@", -1)
    domain_seed = F.concat_ws("|", F.lit(key), domain)
    domain_noise = F.concat(F.sha2(domain_seed, 256), F.sha2(domain_seed, 256))
    octets = [_number(noise, F.lit(i), 254) + 1 for i in range(4)]
    script = F.substring_index(form, " ", 1)
    length = 3 + attempt // 3
    wide = F.sha2(F.concat(seed, F.lit("w")), 256)
    more = max(0, attempt - OWN_FORMAT + 1)
    letters, digits = (_filled(F.lit(x * more), wide) if more else F.lit("") for x in "a0")
    # A secret without letters and digits is drawn as letters.
    shape = F.when(form.rlike(r"[\p{L}0-9]"), form).otherwise(F.repeat(F.lit("a"), F.length(form)))

    def family(name: str) -> Column:
        parts = [_chosen(SYLLABLES[name], noise, i) for i in range(length)]
        return F.concat(F.lit(name + " "), F.lower(F.concat(*parts)))

    def first(name: str, gender: str) -> Column:
        syllables = [_chosen(SYLLABLES[name], wide, i) for i in range(max(0, attempt - 3))]
        return F.lower(F.concat(_chosen(FIRST_NAMES[name, gender], noise, 1), *syllables))

    own = F.substring_index(form, " ", 2)
    firsts = F.when(F.lit(False), "")
    for name, gender in FIRST_NAMES:
        firsts = firsts.when(own == f"{name} {gender}", first(name, gender))

    return (
        F.when(kind == "first", F.concat_ws(" ", F.substring_index(form, " ", 3), firsts))
        .when(
            kind == "email",
            F.concat(
                _filled(local, noise), letters, F.lit("@"), _filled(F.lit("aaaaaa"), domain_noise), F.lit(".example")
            ),
        )
        .when(kind == "key", F.concat(F.left(form, F.lit(4)), F.left(F.upper(noise), F.lit(16)), letters))
        .when(kind == "hex", F.concat(F.left(noise, F.length(form)), digits))
        .when(
            kind == "phone",
            F.concat(F.left(form, F.lit(2)), _filled(F.substring(form, 3, 100), noise), digits),
        )
        .when(kind == "card", F.concat(F.left(form, F.lit(1)), _filled(F.substring(form, 2, 100), noise), digits))
        .when(kind == "iban", F.concat(F.left(form, F.lit(2)), _filled(F.substring(form, 3, 100), noise), digits))
        .when(kind == "ip", F.concat(F.concat_ws(".", *[x.cast("string") for x in octets]), digits))
        .when((kind == "name") & (script == "cyrillic"), family("cyrillic"))
        .when(kind == "name", family("latin"))
        .when(kind == "ssn", F.concat(_filled(form, noise), digits))
        .otherwise(F.concat(_filled(shape, noise), letters))
    )


def surrogates(forms: DataFrame, key: str) -> DataFrame:
    """(kind, form, surrogate) of distinct canonical forms, all surrogates distinct.

    Of the forms that draw the same surrogate the smallest has it; the others draw
    again, as do those whose draw is a real form. Each round is written.
    """
    forms = _stored(forms.select("kind", "form").distinct(), "forms")
    left, settled = forms, []
    for attempt in count():
        drawn = _stored(
            left.withColumn("surrogate", draw(F.col("kind"), F.col("form"), key, attempt)), "draws"
        )
        winner = drawn.groupBy("kind", "surrogate").agg(F.min("form").alias("form"))
        taken = [forms.select("kind", F.col("form").alias("surrogate"))]
        taken += [x.select("kind", "surrogate") for x in settled]
        good = winner
        for others in taken:
            good = good.join(others, ["kind", "surrogate"], "left_anti")
        good = _stored(good.select("kind", "form", "surrogate"), "surrogates")
        settled.append(good)
        left = _stored(left.join(good, ["kind", "form"], "left_anti"), "left")
        if left.isEmpty():
            return reduce(DataFrame.unionAll, settled)


def _poured(entity: Column, form: Column) -> Column:
    """``entity`` with its digits replaced in order by those of ``form``; more follow at the end."""
    digits = F.regexp_replace(form, "[^0-9]", "")

    def digit(letter: Column, at: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(entity, F.lit(1), at + 1), "[^0-9]", ""))
        return F.when(letter.rlike("^[0-9]$"), F.substring(digits, before, F.lit(1))).otherwise(letter)

    own = F.length(F.regexp_replace(entity, "[^0-9]", ""))
    rest = F.substring(digits, own + 1, F.length(digits))
    return F.concat(F.array_join(F.transform(F.split(entity, ""), digit), ""), rest)


def written(kind: Column, entity: Column, surrogate: Column, first_surrogate: Column) -> Column:
    """``surrogate`` in the format of ``entity``; a name with a first name takes that of its own."""
    words = F.split(entity, " ")
    title = F.get(words, F.lit(0))
    first = F.initcap(F.substring_index(first_surrogate, " ", -1))
    last = F.initcap(F.substring_index(surrogate, " ", -1))
    name = F.when(F.size(words) > 2, F.concat_ws(" ", title, first, last)).otherwise(
        F.concat_ws(" ", title, last)
    )
    return (
        F.when(kind.isin("phone", "ssn", "card"), _poured(entity, surrogate))
        .when(kind == "password", F.concat(F.regexp_extract(entity, _SECRET_PREFIX, 0), surrogate))
        .when((kind == "iban") & entity.contains(" "), F.regexp_replace(surrogate, "(.{4})(?=.)", "$1 "))
        .when((kind == "email") & (entity == F.upper(entity)), F.upper(surrogate))
        .when(kind == "name", name)
        .otherwise(surrogate)
    )


def replacements(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(text_key, replaced): for each text with entities, what each of them becomes."""
    text = F.col(text_col).cast("string")
    found = (
        docs.select(text.alias("text"))
        .where(suspicious(F.col("text")))
        .select(F.sha2("text", 256).alias("text_key"), entities(F.col("text")).alias("entities"))
        .where(F.size("entities") > 0)
    )
    found = found.select("text_key", F.explode(F.array_distinct("entities")).alias("entity"))
    found = _stored(found.distinct(), "entities")
    entity, kind = F.col("entity"), F.col("kind")
    placed = found.withColumn("kind", kind_of(entity)).where(kind.isNotNull())
    placed = placed.withColumn("form", canonical(kind, entity))
    placed = placed.withColumn("first_form", F.when(kind == "name", first_name(entity)))
    firsts = placed.where("first_form is not null").select(
        F.lit("first").alias("kind"), F.col("first_form").alias("form")
    )
    drawn = surrogates(placed.select("kind", "form").unionAll(firsts), key)
    drawn = _stored(drawn, "surrogates")
    first_drawn = drawn.where("kind = 'first'").select(
        F.col("form").alias("first_form"), F.col("surrogate").alias("first_surrogate")
    )
    replaced = placed.join(drawn, ["kind", "form"]).join(first_drawn, "first_form", "left").select(
        "text_key",
        "kind",
        F.struct(entity, written(kind, entity, F.col("surrogate"), F.col("first_surrogate")).alias("surrogate")).alias("e"),
    )
    return _stored(
        replaced.groupBy("text_key").agg(
            F.map_from_entries(F.collect_list("e")).alias("replaced"),
            F.array_sort(F.collect_set("kind")).alias("kinds"),
        ),
        "replacements",
    )


def _rewritten(text: Column, replaced: Column) -> Column:
    between = F.split(text, ENTITY, -1)
    found = F.transform(entities(text), lambda e: F.coalesce(F.element_at(replaced, e), e))
    parts = F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.array_join(parts, "")


def pseudonymise(
    docs: DataFrame, key: str, text_col: str = "text", report: bool = False
) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced by surrogates.

    ``key`` makes the surrogates: without it, who knows the method could draw those of
    guessed data. ``report`` adds n_entities (places) and kinds (sorted, comma-joined). Null, empty
    and other texts without entities stay as they are; repeated rows are rewritten
    alike; other columns are passed on whatever their names, but for the two of the
    report. No rows give no rows.
    """
    spark = docs.sparkSession
    names = docs.columns
    text = F.col(text_col).cast("string")
    made = replacements(docs, key, text_col)
    row = F.struct(*[F.col(f"`{name}`") for name in names]).alias("row")
    plain = docs.where(~suspicious(text)).select(
        row, text.alias("new"), F.lit(0).alias("n_entities"), F.lit("").alias("kinds")
    )
    searched = (
        docs.where(suspicious(text))
        .select(row, F.sha2(text, 256).alias("text_key"))
        .join(made, "text_key", "left")
    )
    old, replaced = F.col("row").getField(text_col).cast("string"), F.col("replaced")
    changed = searched.select(
        "row",
        F.when(replaced.isNull(), old).otherwise(_rewritten(old, replaced)).alias("new"),
        F.when(replaced.isNull(), 0).otherwise(F.size(entities(old))).alias("n_entities"),
        F.coalesce(F.array_join("kinds", ","), F.lit("")).alias("kinds"),
    )
    both = plain.unionAll(changed)
    columns = [
        F.col("new").alias(name) if name == text_col else F.col("row").getField(name).alias(name)
        for name in names
    ]
    extra = [F.col("n_entities").cast("long").alias("n_entities"), "kinds"] if report else []
    return both.select(*columns, *extra)
