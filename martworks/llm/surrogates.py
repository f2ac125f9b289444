"""PII surrogates: keyed, type-consistent replacements, in DataFrame functions only.

Found are e-mail addresses, IPv4 and IPv6 addresses, IBANs, long hexadecimal and prefixed secrets,
phone, social-security and card or account numbers, and persons: names after a form of
address, or a known given name with a surname, and bare mentions of those names in the
same text. Each distinct entity of the table (its type and its normal form: digits
of a number, lower case of an address or name) gets one replacement drawn from a keyed
SHA-512 of both, so all its mentions, in whatever format, stay one entity. Digits become
digits and letters letters of the same script, case and punctuation are those of the
mention, given names keep gender and script (Latin, Cyrillic, Greek; other scripts become
Latin), card numbers that pass the Luhn test still do, IP addresses come from the reserved
blocks 240.0.0.0/4 and 2001:db8::/32.

Collision checks: a replacement that another entity of the type has, or that is itself an
entity of the table, is drawn again for all but the smallest normal form, until each
entity has its own; from the fourth draw on, given names are made up and names and the
local parts of addresses get longer with each draw, from the thirteenth on numbers do, so that
no space runs out. All of it is joins and aggregations over the distinct entities.

Texts without an entity are passed through and never shuffled. The others are joined with
their replacements by two 64-bit hashes of the text, so that copies of a text share one
row of replacements, and then dealt evenly over the tasks that rewrite them.

Defined cases: null and empty texts stay as they are; rows with equal text get equal
results; ids may be null or repeated; an empty table gives no rows; further columns are
kept and never looked at, columns of the text or its replacements cannot clash with them
since their names are drawn for each call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import staged

DEFAULT_KEY = "martworks surrogates"
LISTED_DRAWS = 3
#: Tasks that write the changed texts, for each core.
TASKS_PER_CORE = 4
#: Draws after which numbers may be longer than those they stand for.
GROWING_DRAWS = 12

# Given names by gender and script, forms of address by gender.
GIVEN = {
    ("m", "latin"): (
        "James John Robert Michael William David Richard Thomas Daniel Paul Mark George Peter "
        "Pierre Jean Louis Henri Luc Hans Klaus Jürgen Stefan Wolfgang Dieter José Carlos Juan "
        "Luis Miguel Pedro Javier Antonio"
    ).split(),
    ("f", "latin"): (
        "Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Nancy Emma Alice Anna "
        "Marie Jeanne Claire Sophie Camille Ursula Monika Petra Sabine Heike Ingrid María Carmen "
        "Lucía Elena Isabel Pilar Teresa Rosa"
    ).split(),
    ("m", "cyrillic"): (
        "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил Владимир Борис Павел Олег"
    ).split(),
    ("f", "cyrillic"): (
        "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Вера Нина Юлия"
    ).split(),
    ("m", "greek"): "Γιώργος Κώστας Νίκος Δημήτρης Γιάννης Παύλος Πέτρος Αλέξης".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Βασιλική Δέσποινα Ειρήνη".split(),
}
ADDRESS = {
    "m": r"Mr|Sir|Herrn?|Monsieur|Señor|господин|г-н|κύριος|Κύριος",
    "f": r"Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|госпожа|г-жа|κυρία|Κυρία",
    "": r"Dr|Prof|Professor|Doctor|Doktor|Docteur|Doctora?",
}
LATIN, CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыэюя"
GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
SYLLABLES = {
    "latin": "bal ber bor cal cor dan del dor fal fer gan gor hal han kel kor lan lin mar mel "
    "mor nal nor pel ral ran sal san tan tor val wen".split(),
    "cyrillic": "бал бер бор вал вер гор дан дел дор зан зор кал кор лан лин мар мел мор нал "
    "нор пал пел рал ран сал сан тал тар тор фал хан чан".split(),
    "greek": "βαλ βερ βορ γαν γορ δαν δελ δορ ζαν ζορ θαλ θερ καλ κορ λαν λιν μαρ μελ μορ ναλ "
    "νορ παλ πελ ραλ ραν σαλ σαν ταλ ταρ τορ φαλ χαν".split(),
}

_NAME = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:['’-]\p{Lu}\p{Ll}+)*"
_FORMS = "|".join(ADDRESS.values())
_KNOWN = "|".join(name for names in GIVEN.values() for name in names)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Type and pattern, in the order of precedence.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,24}+(?![\p{N}])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ip6": r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?:(?=[a-f]*\d)[0-9a-f]{32,128}|(?=[A-F]*\d)[0-9A-F]{32,128}|(?:AKIA|ASIA)[0-9A-Z]{16}"
    r"|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|(?:\(\d{3}\) ?|\d{3}[. -])\d{3}[. -]\d{4}|0\d{2,4}[ /-]\d{5,8})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])",
    "card": r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\p{L}\p{N}])",
    "person": rf"(?=[\p{{Lu}}гκ])(?<![\p{{L}}\p{{N}}])(?:(?:(?:{_FORMS})\.? )+{_NAME}(?: {_NAME}){{0,2}}"
    rf"|(?:{_KNOWN}) {_NAME})(?![\p{{L}}\p{{N}}])",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_OTHER = "|".join(f"(?:{p})" for kind, p in PATTERNS.items() if kind != "person")
_FEMALE = rf"^(?:{ADDRESS['f']})(?![\p{{L}}])"
_MALE = rf"^(?:{ADDRESS['m']})(?![\p{{L}}])"
_TITLE = rf"^(?:(?:{_FORMS})\.? )+"


def _kind(entity: Column) -> Column:
    out = F.lit("mention")
    for name, pattern in reversed(PATTERNS.items()):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _gender(name: Column, mention: Column) -> Column:
    """By the given name if it is known, else by the form of address."""
    out = F.when(mention.rlike(_FEMALE), F.lit("f")).when(mention.rlike(_MALE), F.lit("m"))
    for gender in ("f", "m"):
        known = [n for (g, _), names in GIVEN.items() if g == gender for n in names]
        out = F.when(name.isin(known), F.lit(gender)).otherwise(out)
    return F.coalesce(out, F.lit("m"))


def _script(name: Column) -> Column:
    return (
        F.when(name.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic"))
        .when(name.rlike(r"\p{IsGreek}"), F.lit("greek"))
        .otherwise(F.lit("latin"))
    )


def _names(entity: Column) -> Column:
    return F.split(F.regexp_replace(entity, _TITLE, ""), " ")


def _person_keys(entity: Column) -> Column:
    """Keys of the names of a person's mention: a single name after a title is a surname."""
    names = _names(entity)
    titled = entity.rlike(_TITLE)

    def key(name, i):
        given = (i < F.size(names) - 1) | (~titled & (F.size(names) == 1))
        kind = F.concat_ws(
            "/",
            F.when(given, F.concat(F.lit("given-"), _gender(name, entity))).otherwise("surname"),
            _script(name),
        )
        return F.concat_ws("|", kind, F.lower(name))

    return F.transform(names, key)


def _normal(kind: Column, entity: Column) -> Column:
    digits = F.regexp_replace(entity, r"\D", "")
    country = F.regexp_extract(entity, r"^\+(\d{1,3})(?=\D)", 1)
    phone = F.when(
        country != "", F.concat(country, F.lit("+"), F.substring(digits, F.length(country) + 1, 99))
    ).otherwise(digits)
    return (
        F.when(kind == "phone", phone)
        .when(kind.isin("ssn", "card"), digits)
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "secret", entity)
        .otherwise(F.lower(entity))
    )


def _keys(entity: Column) -> Column:
    """Keys (type, bar, normal form) of what one mention names."""
    kind = _kind(entity)
    plain = F.array(F.concat_ws("|", kind, _normal(kind, entity)))
    return F.when(kind == "person", _person_keys(entity)).otherwise(plain)


def _draw(key: str, entity: Column, attempt: int) -> Column:
    """256 hex digits that only the key's holder can draw for an entity."""
    seed = lambda part: F.concat_ws("#", F.lit(key), entity, F.lit(f"{attempt}#{part}"))
    return F.concat(*[F.sha2(seed(p), 512) for p in (0, 1)])


def _byte(draw: Column, i: Column) -> Column:
    at = F.pmod(i, F.lit(128)) * 2 + 1
    return F.conv(F.substring(draw, at, F.lit(2)), 16, 10).cast("int")


def _one_of(letters: str | list[str], value: Column) -> Column:
    table = F.array(*[F.lit(x) for x in letters])
    return F.element_at(table, (F.pmod(value, F.lit(len(letters))) + 1).cast("int"))


def _alike(text: Column, draw: Column, letters: str = LATIN) -> Column:
    """Digits for digits, letters for letters of the same script and case, marks kept."""

    def one(c, i):
        v = _byte(draw, i)
        small = (
            F.when((c >= "0") & (c <= "9"), F.pmod(v, F.lit(10)).cast("string"))
            .when(F.lower(c).rlike(r"\p{IsCyrillic}"), _one_of(CYRILLIC, v))
            .when(F.lower(c).rlike(r"\p{IsGreek}"), _one_of(GREEK, v))
            .when(c.rlike(r"\p{L}"), _one_of(letters, v))
            .otherwise(c)
        )
        return F.when(c != F.lower(c), F.upper(small)).otherwise(small)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a number, its last digit counted once."""
    values = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.pmod(c.cast("int") * 2, F.lit(10)) + (c.cast("int") * 2 / 10).cast("int")
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x.cast("int"))


def _card(normal: Column, draw: Column) -> Column:
    drawn = _alike(normal, draw)
    head = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    check = F.pmod(-_luhn(F.concat(head, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(F.pmod(_luhn(normal), F.lit(10)) == 0, F.concat(head, check)).otherwise(drawn)


def _made_up(kind: Column, draw: Column, attempt: int) -> Column:
    """A name of four syllables, and of one more for each draw beyond the listed ones."""
    places = range(1, 5 + max(0, attempt - LISTED_DRAWS))
    parts = lambda script: F.concat(*[_one_of(SYLLABLES[script], _byte(draw, F.lit(i))) for i in places])
    out = parts("latin")
    for script in ("cyrillic", "greek"):
        out = F.when(kind.endswith(script), parts(script)).otherwise(out)
    return out


def _replacement(key: str, entity: Column, attempt: int) -> Column:
    """The replacement of an entity (type, bar, normal form) in its normal form."""
    kind = F.substring_index(entity, "|", 1)
    normal = F.substring(entity, F.length(kind) + 2, F.length(entity))
    draw = _draw(key, entity, attempt)
    tld = F.regexp_extract(normal, r"\.\p{L}+$", 0)
    mail = F.concat(
        _alike(F.substring(normal, F.lit(1), F.length(normal) - F.length(tld)), draw), tld
    )
    if attempt >= LISTED_DRAWS:
        mail = F.concat(F.substring(draw, 200, 8 + 4 * (attempt - LISTED_DRAWS)), mail)
    address = F.concat_ws(
        ".",
        (240 + F.pmod(_byte(draw, F.lit(0)), F.lit(15))).cast("string"),
        *[_byte(draw, F.lit(i)).cast("string") for i in (1, 2, 3)],
    )
    country = F.regexp_extract(normal, r"^\d+\+", 0)
    phone = F.concat(
        country, _alike(F.substring(normal, F.length(country) + 1, F.length(normal)), draw)
    )
    prefix = F.regexp_extract(normal, r"^(?:AKIA|ASIA|gh[pousr]_|sk-)", 0)
    tail = F.substring(normal, F.length(prefix) + 1, F.length(normal))
    secret = F.concat(
        prefix,
        F.when(prefix == "", _alike(tail, draw, "abcdef")).otherwise(_alike(tail, draw)),
    )
    iban = F.concat(
        F.substring(normal, 1, 2), _alike(F.substring(normal, F.lit(3), F.length(normal)), draw)
    )
    name = _made_up(kind, draw, attempt)
    if attempt < LISTED_DRAWS:
        for (gender, script), names in GIVEN.items():
            value = _byte(draw, F.lit(0)) * 256 + _byte(draw, F.lit(1))
            name = F.when(
                kind == f"given-{gender}/{script}", F.lower(_one_of(names, value))
            ).otherwise(name)
    groups = [F.substring(draw, 101 + 4 * i, 4) for i in range(6)]
    address6 = F.concat_ws(":", F.lit("2001:db8"), *groups)
    card, ssn = _card(normal, draw), _alike(normal, draw)
    if attempt >= GROWING_DRAWS:
        # more numbers of this form in the table than there are others: longer ones are left
        longer = F.translate(F.substring(draw, 1, attempt - GROWING_DRAWS + 1), "abcdef", "012345")
        phone, card, ssn, iban = (F.concat(c, longer) for c in (phone, card, ssn, iban))
        address = address6
    return (
        F.when(kind == "email", mail)
        .when(kind == "ip", address)
        .when(kind == "ip6", address6)
        .when(kind == "iban", iban)
        .when(kind == "secret", secret)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ssn", ssn)
        .otherwise(name)
    )


def replacements(entities: DataFrame, key: str) -> DataFrame:
    """(entity, core) for distinct ``entities`` (entity): one core of its own for each."""
    entities = staged(entities, "entities")
    kind = F.substring_index("entity", "|", 1)
    # names of both genders and of any rank share one space
    space = F.when(kind.rlike("^(given|surname)"), F.lit("name")).otherwise(kind)
    real = entities.select(
        F.concat_ws("|", space, F.expr("substring(entity, instr(entity, '|') + 1)")).alias("core_id")
    ).distinct()
    done, left, attempt = None, entities, 0
    while True:
        drawn = left.withColumn("core", _replacement(key, F.col("entity"), attempt))
        drawn = staged(
            drawn.withColumn("core_id", F.concat_ws("|", space, F.lower("core"))), "drawn"
        )
        free = drawn.join(real, "core_id", "left_anti")
        if done is not None:
            free = free.join(done.select("core_id"), "core_id", "left_anti")
        first = free.groupBy("core_id").agg(F.min("entity").alias("entity"))
        kept = drawn.join(first, ["core_id", "entity"], "left_semi")
        kept = staged(kept if done is None else done.unionByName(kept), "replacements")
        left = entities.join(kept, "entity", "left_anti")
        done, attempt = kept, attempt + 1
        if left.isEmpty():
            return done.select("entity", "core")


def _cased(mention: Column, core: Column) -> Column:
    """A name or address in the case of its mention."""
    capital = F.concat(F.upper(F.substring(core, 1, 1)), F.substring(core, F.lit(2), F.length(core)))
    return (
        F.when((mention == F.upper(mention)) & (F.length(mention) > 1), F.upper(core))
        .when(F.substring(mention, 1, 1).rlike(r"\p{Lu}"), capital)
        .otherwise(core)
    )


def _in_format(mention: Column, core: Column) -> Column:
    """Letters and digits of ``core`` one by one in the places of the mention's."""
    signs = F.regexp_replace(core, r"[^\p{L}\p{N}]", "")

    def one(c, i):
        rank = F.length(
            F.regexp_replace(F.substring(mention, F.lit(1), i + 1), r"[^\p{L}\p{N}]", "")
        )
        return F.when(c.rlike(r"[\p{L}\p{N}]"), F.substring(signs, rank, F.lit(1))).otherwise(c)

    places = F.length(F.regexp_replace(mention, r"[^\p{L}\p{N}]", ""))
    longer = F.substring(signs, places + 1, F.length(signs))
    return F.concat(F.array_join(F.transform(F.split(mention, ""), one), ""), longer)


def _render(mention: Column, cores: Column) -> Column:
    """The text that stands for a mention; ``cores``: map of entity to core."""
    kind = _kind(mention)
    entity = F.element_at(_keys(mention), 1)
    core = F.element_at(cores, entity)
    title = F.regexp_extract(mention, _TITLE, 0)
    names, keys = _names(mention), _person_keys(mention)
    person = F.concat(
        title,
        F.array_join(
            F.transform(names, lambda n, i: _cased(n, F.element_at(cores, F.get(keys, i)))), " "
        ),
    )
    surname = F.concat_ws("/", F.lit("surname"), _script(mention))
    bare = F.coalesce(
        *[
            F.element_at(cores, F.concat_ws("|", kind_of_name, F.lower(mention)))
            for kind_of_name in (
                surname,
                F.concat_ws("/", F.lit("given-f"), _script(mention)),
                F.concat_ws("/", F.lit("given-m"), _script(mention)),
            )
        ]
    )
    return (
        F.when(kind == "person", person)
        .when(kind.isin("phone", "ssn", "card", "iban"), _in_format(mention, core))
        .when(kind == "email", _cased(mention, core))
        .when(kind == "mention", _cased(mention, bare))
        .otherwise(core)
    )


def _has_entity(text: Column) -> Column:
    """Whether a text matches any pattern. All but persons hold one of a few signs, which
    most texts lack: those are looked for first."""
    signs = text.rlike("[0-9@]|::")
    for prefix in ("AKIA", "ASIA", "sk-", "_"):
        signs = signs | text.contains(prefix)
    found = (signs & text.rlike(_OTHER)) | text.rlike(PATTERNS["person"])
    return F.coalesce(found, F.lit(False))


def _mentions(text: Column) -> tuple[Column, Column]:
    """(pattern of a text, its mentions): the entities and bare names of its persons."""
    found = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    persons = F.filter(found, lambda e: e.rlike(f"^(?:{PATTERNS['person']})$"))
    names = F.array_distinct(F.flatten(F.transform(persons, _names)))
    bare = F.concat(
        F.lit(_ANY + r"|(?<![\p{L}\p{N}])(?:"),
        F.array_join(F.concat(names, F.transform(names, F.upper)), "|"),
        F.lit(r")(?![\p{L}\p{N}])"),
    )
    pattern = F.when(F.size(persons) > 0, bare).otherwise(F.lit(_ANY))
    return pattern, F.when(
        F.size(persons) > 0, F.regexp_extract_all(text, pattern, F.lit(0))
    ).otherwise(found)


def pseudonymize(docs: DataFrame, column: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with the entities in ``column`` replaced; all other columns as they are."""
    tag = uuid.uuid4().hex[:8]
    h1, h2, cores = f"h1_{tag}", f"h2_{tag}", f"cores_{tag}"
    text = F.col(f"`{column}`")
    hit = _has_entity(text)
    hashes = [F.xxhash64(text).alias(h1), F.xxhash64(F.lit(tag), F.reverse(text)).alias(h2)]
    found = (
        docs.where(hit)
        .select(*hashes, F.array_distinct(_mentions(text)[1]).alias("mentions"))
        .dropDuplicates([h1, h2])
    )
    named = F.filter("mentions", lambda m: _kind(m) != "mention")
    found = staged(
        found.select(
            h1, h2, F.explode(F.array_distinct(F.flatten(F.transform(named, _keys)))).alias("entity")
        ),
        "found",
    )
    drawn = replacements(found.select("entity").distinct(), key)
    of_text = (
        found.join(drawn, "entity")
        .groupBy(h1, h2)
        .agg(F.map_from_entries(F.collect_list(F.struct("entity", "core"))).alias(cores))
    )
    changed = docs.where(hit).select("*", *hashes).join(of_text, [h1, h2])
    # a row costs far more than its bytes: what the join has packed by size is dealt anew
    tasks = TASKS_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism
    changed = changed.repartition(tasks)
    pattern, mentions = _mentions(text)
    gaps = F.split(text, pattern, -1)
    rebuilt = F.concat(
        F.array_join(
            F.transform(
                mentions,
                # a mention without a replacement would stay; its text is never lost
                lambda m, i: F.concat(F.get(gaps, i), F.coalesce(_render(m, F.col(cores)), m)),
            ),
            "",
        ),
        F.element_at(gaps, -1),
    )
    changed = changed.withColumn(column, rebuilt).select(*[f"`{c}`" for c in docs.columns])
    return docs.where(~hit).union(changed)
