"""PII surrogates, in DataFrame operations alone.

Emails, phone numbers, payment cards (with a right check digit), US social-security numbers, IBANs, IPv4 addresses and
names behind a title are found in one pass of a combined pattern; a name that stands behind a title somewhere in a text is
replaced wherever it stands in that text as a word. Every distinct entity of the corpus gets one surrogate, drawn by a
keyed SHA-256 and of the same kind: digits for digits and letters for letters in the same places, a card with a right
check digit, an address with four octets, a given name of the gender that its titles in the corpus tell (neither, if they
differ or tell none) and of the name's script. A surrogate is refused if it belongs to an entity of the corpus, if it was
given before, or if another entity drew it (the smallest keeps it); the refused draw again until none is left. So different
entities stay different, and mentions of one entity, however they are set (upper or lower case of an email, separators of
a number, an American number with or without +1), stay one. The key must be kept secret: who has it can try candidates.

Only mentions are shuffled, and the texts that hold any; all others pass through. Mentions of a hot entity are joined
to its one row, which Spark splits where the join is skewed.

Defined cases: a null text stays null and an empty one empty, with no entity. Repeated rows are treated alike. An empty
table gives an empty result. All other columns, whatever their names, are carried along; ``text`` is replaced and
``n_pii`` (long) is appended (an input column of that name is dropped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangelake.llm.shared import cut, shared_folder

#: Rounds of drawing; a round leaves the entities whose surrogate was refused, so this many mean that a space is used up.
ROUNDS = 60

# Titles by gender, and given names by gender and script.
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Госпожа", "Κυρία"], "m": ["Mr", "Herr", "Monsieur", "Señor", "Господин", "Κύριος"], "n": ["Dr", "Prof"]}
GIVEN = {
    "latin": {"f": ["Alma", "Clara", "Edith", "Greta", "Irene", "Laura", "Nora", "Vera"], "m": ["Adam", "Bruno", "Emil", "Hugo", "Jonas", "Leon", "Oscar", "Paul"], "n": ["Alex", "Charlie", "Jules", "Kim", "Noel", "Robin", "Sam", "Toni"]},
    "cyrillic": {"f": ["Анна", "Вера", "Ирина", "Мария"], "m": ["Антон", "Борис", "Иван", "Павел"], "n": ["Женя", "Саша", "Слава", "Валя"]},
    "greek": {"f": ["Άννα", "Ελένη", "Μαρία", "Σοφία"], "m": ["Γιώργος", "Νίκος", "Παύλος", "Πέτρος"], "n": ["Αλέξης", "Βαγγέλης", "Σάκης", "Φώτης"]},
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "hal", "kin", "lo", "mar", "nes", "pol", "ric", "san", "ter", "ul", "vor", "win"],
    "cyrillic": ["ба", "вор", "гул", "ден", "жан", "зин", "ков", "лар", "мин", "нов", "пет", "рос", "сол", "тар", "фед", "чен"],
    "greek": ["βα", "γορ", "δεν", "ζαν", "θαλ", "κιν", "λο", "μαρ", "νες", "πολ", "ρικ", "σαν", "τερ", "φελ", "χορ", "ψιν"],
}

_TITLE = "(?:" + "|".join(t for group in TITLES.values() for t in group) + ")"
_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,255}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])",
    "person": rf"(?<!\p{{L}}){_TITLE}\.? {_NAME}(?: {_NAME})?(?!\p{{L}})",
}
ANY = "|".join(PATTERNS.values())


def _is(kind: str, match: Column) -> Column:
    return match.rlike(f"^(?:{PATTERNS[kind]})$")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _american(match: Column) -> Column:
    """Whether a phone number has +1 and ten digits: without them it is the same number."""
    return match.startswith("+1") & (F.length(_digits(match)) == 11)


def luhn_sum(digits: Column) -> Column:
    """Sum of a number's digits, every second from the right doubled."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def gender(title: Column) -> Column:
    bare = F.regexp_replace(title, r"\.", "")
    return F.when(bare.isin(TITLES["f"]), "f").when(bare.isin(TITLES["m"]), "m").otherwise("n")


def parts(match: Column) -> Column:
    """A match as (kind, entity, raw, gender): one part, or a title and one part a name. Kind '' is text that stays."""

    def part(kind: Column | str, entity: Column, raw: Column, told: Column | None = None) -> Column:
        return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), entity.alias("entity"), raw.alias("raw"), (F.lit("n") if told is None else told).alias("gender"))

    words = F.split(match, " ")
    surname, given = F.element_at(words, -1), F.try_element_at(words, F.lit(2))
    title = part("", F.lit(""), F.concat(words[0], F.lit(" ")))
    first = part(F.concat(F.lit("given-"), script(given)), F.lower(given), given, gender(words[0]))
    last = part(F.concat(F.lit("surname-"), script(surname)), F.lower(surname), surname)
    named = F.when(F.size(words) == 3, F.array(title, first, part("", F.lit(""), F.lit(" ")), last)).otherwise(F.array(title, last))
    digits = _digits(match)
    phone = F.when(_american(match), F.substring(digits, 2, 10)).when(match.startswith("+"), F.concat(F.lit("+"), digits)).otherwise(digits)
    plain = (
        F.when(_is("email", match), F.array(part("email", F.lower(match), match)))
        .when(_is("iban", match), F.array(part("iban", F.regexp_replace(match, " ", ""), match)))
        .when(_is("ip", match), F.array(part("ip", match, match)))
        .when(_is("ssn", match), F.array(part("ssn", digits, match)))
        .when(_is("card", match) & (luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$"), F.array(part("card", digits, match)))
        .when(_is("phone", match), F.array(part("phone", phone, match)))
        .when(_is("person", match), named)
    )
    return F.coalesce(plain, F.array(part("", F.lit(""), match)))


def _fill(shape: Column, draw: Column) -> Column:
    """``shape`` with its ASCII digits and letters drawn anew, in place and case: each character has a byte of the draw."""
    n = F.length(shape)

    def one(i: Column) -> Column:
        c = F.substring(shape, i, F.lit(1))
        # two hex digits a character from 64; longer shapes take from rehashed draws
        chunk = F.sha2(F.concat(draw, F.floor((i - 1) / 32).cast("string")), 256)
        byte = F.conv(F.substring(chunk, ((i - 1) % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return F.when(c.rlike("[0-9]"), (byte % 10).cast("string")).when(c.rlike("[a-z]"), F.char(byte % 26 + 97)).when(c.rlike("[A-Z]"), F.char(byte % 26 + 65)).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), n), one), "")


def _pick(values: list[str], draw: Column, at: int) -> Column:
    index = (F.conv(F.substring(draw, at, 6), 16, 10).cast("long") % len(values)).cast("int")
    return F.array(*map(F.lit, values))[index]


def surrogate(kind: Column, entity: Column, told: Column, attempt: int, key: str) -> Column:
    """An entity's surrogate, itself in the form of an entity. ``told``: a given name's gender."""
    draw = F.sha2(F.concat_ws("|", F.lit(key), kind, entity, F.lit(str(attempt))), 256)
    more = F.lit("") if attempt < 3 else F.concat(F.lit("."), F.substring(draw, 41, attempt))
    email = F.concat(_fill(F.substring_index(entity, "@", 1), draw), more, F.lit("@"), _fill(F.regexp_extract(entity, r"@(.*)\.[^.]*$", 1), F.reverse(draw)), F.lit("."), _pick(["example", "invalid", "test"], draw, 20))
    octets = [F.conv(F.substring(draw, 1 + 2 * i, 2), 16, 10).cast("int") for i in range(4)]
    ip = F.concat_ws(".", (octets[0] % 223 + 1).cast("string"), *[o.cast("string") for o in octets[1:]])
    ssn = F.concat(F.lit("9"), _fill(F.substring(entity, 2, 8), draw))
    body = F.concat(F.substring(entity, 1, 1), _fill(F.expr("substring(entity, 2, length(entity) - 2)"), draw))
    card = F.concat(body, ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    abroad = F.concat(F.substring(entity, 1, 3), _fill(F.expr("substring(entity, 4)"), draw))
    phone = F.when(entity.startswith("+"), abroad).otherwise(F.concat(_pick([str(d) for d in range(2, 10)], draw, 50), _fill(F.expr("substring(entity, 2)"), draw)))
    iban = F.concat(F.substring(entity, 1, 2), _fill(F.expr("substring(entity, 3)"), draw))
    value = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ssn", ssn).when(kind == "card", card).when(kind == "phone", phone).when(kind == "iban", iban)
    for s in GIVEN:
        syllables = [_pick(SYLLABLES[s], draw, 1 + 3 * i) for i in range(min(2 + attempt, 18))]
        for g in GIVEN[s]:  # pools are short: from the second draw on a name is lengthened
            value = value.when((kind == f"given-{s}") & (told == g), F.lower(F.concat(_pick(GIVEN[s][g], draw, 10), F.lit("-" if attempt else ""), *syllables[:attempt])))
        value = value.when(kind == f"surname-{s}", F.concat(*syllables))
    return value


def dictionary(entities: DataFrame, key: str, folder: str) -> DataFrame:
    """(kind, entity, surrogate) of distinct entities (kind, entity, gender), by rounds of drawing and collision checks."""
    given: DataFrame | None = None
    todo = entities
    for attempt in range(ROUNDS):
        drawn = todo.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), F.col("gender"), attempt, key))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        taken = entities.select("kind", F.col("entity").alias("surrogate"))
        good = first.join(taken, ["kind", "surrogate"], "left_anti")
        if given is not None:
            good = good.join(given.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        good = cut(good.select("kind", "entity", "surrogate"), f"given-{attempt}", folder)
        given = good if given is None else given.unionByName(good)
        todo = cut(todo.join(good, ["kind", "entity"], "left_anti"), f"todo-{attempt}", folder)
        if todo.isEmpty():
            return given
    raise RuntimeError(f"{ROUNDS} draws left entities without a surrogate of their own")


def render(kind: Column, value: Column, raw: Column) -> Column:
    """A surrogate set as the mention was: separators of a number, case of a name or email."""
    n = F.length(raw)
    value = F.when((kind == "phone") & _american(raw), F.concat(F.lit("1"), value)).when((kind == "phone") & value.startswith("+"), F.expr("substring(surrogate, 2)")).otherwise(value)

    def one(acc: Column, i: Column) -> Column:
        c = F.substring(raw, i, F.lit(1))
        takes = c.rlike("[0-9A-Za-z]")
        put = F.when(takes, F.substring(value, acc["used"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["out"], put).alias("out"), (acc["used"] + takes.cast("int")).alias("used"))

    numbered = F.aggregate(F.sequence(F.lit(1), n), F.struct(F.lit("").alias("out"), F.lit(0).alias("used")), one, lambda acc: acc["out"])
    titled = F.array_join(F.transform(F.split(value, "-"), lambda w: F.initcap(w)), "-")
    cased = F.when(kind.startswith("given") | kind.startswith("surname"), F.when(raw == F.upper(raw), F.upper(value)).otherwise(titled))
    email = F.when((raw == F.upper(raw)) & (raw != F.lower(raw)), F.upper(value)).otherwise(value)
    return F.when(kind.isin("phone", "card", "ssn", "iban"), numbered).when(kind == "ip", value).when(kind == "email", email).otherwise(cased)


def surrogates(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the entities in ``text`` replaced, and n_pii, how many mentions a text had."""
    if not key:
        raise ValueError("surrogates need a secret key")
    folder = shared_folder(docs.sparkSession)
    columns = [c for c in docs.columns if c != "n_pii"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    matches = F.coalesce(F.regexp_extract_all(F.col("row.text"), F.lit(ANY), F.lit(0)), F.array().cast("array<string>"))
    # the pattern takes most of the time, so what it finds is kept, beside the texts
    found = cut(rows.select("row", matches.alias("matches"), F.monotonically_increasing_id().alias("id")), "found", folder)
    clean = found.filter(F.size("matches") == 0).select("row.*", F.lit(0).cast("long").alias("n_pii"))

    flagged = found.filter(F.size("matches") > 0)
    mentions = flagged.select("id", F.posexplode("matches").alias("pos", "match")).select("id", "pos", F.posexplode(parts(F.col("match"))).alias("part", "p")).select("id", "pos", "part", "p.*")
    mentions = cut(mentions, "mentions", folder)
    told = F.when(F.max(F.col("gender") == "f") & F.max(F.col("gender") == "m"), "n").when(F.max(F.col("gender") == "f"), "f").when(F.max(F.col("gender") == "m"), "m").otherwise("n")
    entities = cut(mentions.filter("kind != ''").groupBy("kind", "entity").agg(told.alias("gender")), "entities", folder)
    known = dictionary(entities, key, folder)

    replaced = mentions.join(known, ["kind", "entity"], "left")
    out = F.when(F.col("kind") == "", F.col("raw")).otherwise(render(F.col("kind"), F.col("surrogate"), F.col("raw")))
    named = F.col("kind").startswith("surname") | F.col("kind").startswith("given")
    by_row = replaced.groupBy("id").agg(
        F.collect_list(F.struct("pos", "part", out.alias("out"))).alias("outs"),
        F.count(F.when(F.col("kind") != "", True)).alias("n_found"),
        F.collect_set(F.when(named, F.struct("raw", F.col("kind").startswith("given").alias("given"), out.alias("out")))).alias("names"),
    )
    # of a name that is given name and surname in one text, the surname counts where it stands alone
    alone = F.filter("names", lambda x: ~x["given"] | ~F.exists("names", lambda y: (y["raw"] == x["raw"]) & ~y["given"]))
    names = F.map_from_arrays(F.transform(alone, lambda x: x["raw"]), F.transform(alone, lambda x: x["out"]))

    def words(piece: Column) -> Column:
        return F.split(piece, r"(?<=[\p{L}\p{M}])(?![\p{L}\p{M}])|(?<![\p{L}\p{M}])(?=[\p{L}\p{M}])", -1)

    pieces = F.split("row.text", ANY, -1)
    bare = F.transform(pieces, lambda p: F.when(F.size("renamed") > 0, F.array_join(F.transform(words(p), lambda w: F.coalesce(F.try_element_at(F.col("renamed"), w), w)), "")).otherwise(p))
    placed = F.transform(bare, lambda p, i: F.struct(i.alias("pos"), F.lit(-1).alias("part"), p.alias("out")))
    whole = F.array_join(F.transform(F.array_sort(F.concat(placed, F.col("outs"))), lambda x: x["out"]), "")
    alike = F.aggregate(F.transform(pieces, lambda p: F.size(F.filter(words(p), lambda w: F.array_contains(F.map_keys("renamed"), w)))), F.lit(0), lambda a, b: a + b)
    n_bare = F.when(F.size("renamed") > 0, alike).otherwise(0)
    changed = flagged.join(by_row.withColumn("renamed", names), "id").select("row", whole.alias("whole"), (F.col("n_found") + n_bare).cast("long").alias("n_pii"))
    changed = changed.select(*[F.col("whole").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns], "n_pii")
    return clean.unionByName(changed)
