"""Personal data replaced by keyed surrogates of the same type and format.

Entities are found by patterns. Each distinct entity of the corpus (in a canonical form: digits
of a number, lower case of an address) gets one surrogate from a keyed hash, the same wherever it
occurs. A collision check over all surrogates and all found entities sends every second owner of
a surrogate, and every surrogate that is itself somebody's entity, to the next attempt, until
all are distinct. Texts are then rebuilt from the pieces between entities.

Family names are entities of their own, settled first: a person named with and without a given
name, or with another title, keeps one family name. Names have no end of surrogates: each attempt
adds a syllable to a family name, or a further part to a given name.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import packed
from tripledger.sources.scratch import materialize

MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "г-н", "Господин", "κ")
FEMALE = ("Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "г-жа", "Госпожа", "κα")
NEUTRAL = ("Dr", "Prof", "Professor", "Mx")
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Conrad", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Marco", "Oscar", "Paul", "Tom"),
    ("latin", "f"): ("Alma", "Clara", "Dora", "Elsa", "Flora", "Greta", "Ida", "Julia", "Laura", "Marta", "Nora", "Rosa"),
    ("latin", "x"): ("Alex", "Jules", "Kim", "Noa", "Robin", "Sam", "Sascha", "Toni"),
    ("cyrillic", "m"): ("Антон", "Борис", "Глеб", "Иван", "Кирилл", "Олег", "Павел", "Юрий"),
    ("cyrillic", "f"): ("Алла", "Вера", "Дарья", "Елена", "Ирина", "Нина", "Ольга", "Юлия"),
    ("cyrillic", "x"): ("Женя", "Саша", "Валя", "Шура"),
    ("greek", "m"): ("Ανδρέας", "Γιώργος", "Νίκος", "Πέτρος", "Σταύρος"),
    ("greek", "f"): ("Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Σοφία"),
    ("greek", "x"): ("Άρης", "Χάρις", "Ευ"),
}
SYLLABLES = {
    "latin": ("ber", "dal", "fen", "gar", "hol", "kar", "lin", "mor", "nel", "ros", "san", "ter", "ul", "ven", "wal", "zim"),
    "cyrillic": ("бор", "вел", "гор", "дан", "зим", "кар", "лин", "мор", "нов", "пол", "рос", "сан", "тер", "фед", "хол", "шир"),
    "greek": ("βελ", "γαρ", "δαν", "ζαν", "θεο", "καρ", "λιν", "μαρ", "νικ", "παλ", "ροδ", "σαν", "ταρ", "φιλ", "χαρ", "ψαρ"),
}
_TITLES = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=lambda t: (-len(t), t)))
#: Patterns by type; the first that matches a whole entity names its type.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|AKIA[0-9A-Z]{16}|(?:sk|ghp|xoxb|glpat)[-_][A-Za-z0-9_-]{16,})(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d[ -]?){12,18}\d(?!\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{_TITLES})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What any text with an entity holds.
_HINT = rf"[0-9@]|(?<!\p{{L}})(?:{_TITLES})\.? \p{{Lu}}"


def _kind(entity: Column) -> Column:
    return F.coalesce(*[F.when(entity.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()], F.lit("card"))


def entities_of(text: Column) -> Column:
    """All entities of a text, in order, repeats included."""
    return F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def _canonical(kind: Column, entity: Column) -> Column:
    return (
        F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace(entity, r"\D", ""))
        .when(kind == "email", F.lower(entity)).when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .otherwise(entity)
    )


def _draw(key: str, what: Column, below: int) -> Column:
    """A number from 0 on, keyed, from a string that names the draw: the start of its HMAC (SHA-256)."""
    secret = key.encode() if len(key.encode()) <= 64 else sha256(key.encode()).digest()
    inner, outer = (F.lit(bytes(b ^ pad for b in secret.ljust(64, b"\0"))) for pad in (0x36, 0x5C))
    mixed = F.unhex(F.sha2(F.concat(inner, what.cast("binary")), 256))
    hexed = F.substring(F.sha2(F.concat(outer, mixed), 256), 1, 15)
    return F.pmod(F.conv(hexed, 16, 10).cast("long"), F.lit(below))


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def _alike(key: str, of: Column, text: Column, hexed: bool = False) -> Column:
    """Each digit by a digit, each small or capital letter by its like; the rest stays."""
    low, up = ("abcdef" if hexed else "abcdefghijklmnopqrstuvwxyz"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def one(c: Column, i: Column) -> Column:
        name = F.concat(of, F.lit("\0"), i.cast("string"))
        return (
            F.when(c.rlike("[0-9]"), _draw(key, name, 10).cast("string"))
            .when(c.rlike("[a-z]"), F.substring(F.lit(low), _draw(key, name, len(low)).cast("int") + 1, F.lit(1)))
            .when(c.rlike("[A-Z]"), F.substring(F.lit(up), _draw(key, name, 26).cast("int") + 1, F.lit(1)))
            .otherwise(c))

    return F.when(F.length(text) > 0, _joined(F.transform(F.split(text, ""), one))).otherwise(text)


def _luhn_digit(body: Column) -> Column:
    """The last digit that makes a number valid."""
    doubled = F.transform(F.reverse(F.split(body, "")), lambda c, i: F.when(
        i % 2 == 0, 2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return ((10 - total % 10) % 10).cast("string")


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}{2}"), "cyrillic").when(name.rlike(r"\p{IsGreek}{2}"), "greek").otherwise("latin")


def _words(canon: Column) -> Column:
    return F.split(F.regexp_replace(canon, rf"^(?:{_TITLES})\.? ", ""), " ")


def family_of(canon: Column) -> Column:
    """Script and family name of a name."""
    words = _words(canon)
    return F.concat(_script(canon), F.lit("\0"), F.get(words, F.size(words) - 1))


def _family(key: str, canon: Column, attempt: Column) -> Column:
    """Another family name of the script, a syllable longer with each attempt."""
    script, word = F.substring_index(canon, "\0", 1), F.substring_index(canon, "\0", -1)
    syllables = F.coalesce(*[F.when(script == s, F.array(*map(F.lit, of))) for s, of in SYLLABLES.items()])

    def one(k: Column) -> Column:
        drawn = _draw(key, F.concat(F.lit("family"), k.cast("string"), word, F.lit("\0"), attempt.cast("string")), len(SYLLABLES["latin"]))
        return F.get(syllables, drawn.cast("int"))

    return F.concat(script, F.lit("\0"), F.initcap(_joined(F.transform(F.sequence(F.lit(0), 3 + attempt), one))))


def _name(key: str, canon: Column, attempt: Column, family: Column) -> Column:
    """Title kept; given name by gender and script, in one more part with each attempt; the
    family name's own surrogate."""
    words, script = _words(canon), _script(canon)
    title = F.regexp_extract(canon, rf"^((?:{_TITLES})\.? )", 1)
    bare = F.regexp_replace(title, r"\.? $", "")
    gender = F.when(bare.isin(*MALE), "m").when(bare.isin(*FEMALE), "f").otherwise("x")
    first, last = F.get(words, 0), F.substring_index(family, "\0", -1)

    def given(k: Column) -> Column:
        what = F.concat(F.lit("given"), first, gender, F.when(k > 0, k.cast("string")).otherwise(""))
        return F.coalesce(*[
            F.when((script == s) & (gender == g), F.get(F.array(*map(F.lit, names)), _draw(key, what, len(names)).cast("int")))
            for (s, g), names in GIVEN.items()])

    parts = F.array_join(F.transform(F.sequence(F.lit(0), attempt), given), "-")
    return F.when(F.size(words) > 1, F.concat(title, parts, F.lit(" "), last)).otherwise(F.concat(title, last))


def _iban(canon: Column, plain: Column) -> Column:
    """Another number of the country, with the check digits that make it valid if the first was."""
    country, rest = F.substring(canon, 1, 2), F.substring(plain, F.lit(5), F.length(canon))

    def check(of: Column) -> Column:
        """98 less the remainder by 97 of the number that country and a zero check give."""
        digits = F.transform(F.split(F.concat(of, country, F.lit("00")), ""), lambda c: F.when(
            c.rlike("[0-9]"), c).otherwise((F.ascii(c) - 55).cast("string")))
        left = F.aggregate(F.split(_joined(digits), ""), F.lit(0), lambda a, c: (10 * a + c.cast("int")) % 97)
        return F.lpad((98 - left).cast("string"), 2, "0")

    valid = check(F.substring(canon, F.lit(5), F.length(canon))) == F.substring(canon, 3, 2)
    return F.concat(country, F.when(valid, check(rest)).otherwise(F.substring(plain, 3, 2)), rest)


def _surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """A surrogate in canonical form, of the same type. Names: see `_name`."""
    of = F.concat(kind, F.lit("\0"), canon, F.lit("\0"), attempt.cast("string"))
    plain = _alike(key, of, canon)
    n = F.length(canon)
    # Issuer digit kept; a number that passes the Luhn test gets one that passes it.
    body = F.concat(F.substring(canon, 1, 1), F.substring(plain, F.lit(2), n - 2))
    was_valid = _luhn_digit(F.substring(canon, F.lit(1), n - 1)) == F.substring(canon, n, F.lit(1))
    card = F.concat(body, F.when(was_valid, _luhn_digit(body)).otherwise(F.substring(plain, n, F.lit(1))))
    octets = F.transform(F.split(canon, r"\."), lambda o, i: (
        1 + _draw(key, F.concat(of, F.lit("\0"), i.cast("string")), 254)).cast("string"))
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    host = F.regexp_replace(domain, r"\.[^.]+$", "")
    # A domain has one surrogate for all its addresses, under the reserved label `example`.
    label = F.substring_index(host, ".", 1)
    email = F.concat(_alike(key, of, local), F.lit("@"), _alike(key, F.concat(F.lit("host"), host), label),
                     F.lit(".example"), F.regexp_extract(domain, r"(\.[^.]+)$", 1))
    # Ten digits are drawn; what stands before them, a country code, stays.
    code = F.greatest(n - 10, F.lit(0))
    phone = F.concat(F.substring(canon, F.lit(1), code), F.substring(plain, code + 1, n))
    return (
        F.when(kind == "email", email).when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", card).when(kind == "phone", phone)
        .when(kind == "family", _family(key, canon, attempt))
        .when(kind == "secret", F.when(canon.rlike("^[0-9a-f]+$"), _alike(key, of, canon, hexed=True)).otherwise(
            F.concat(F.regexp_extract(canon, "^(AKIA|[a-z]+[-_]|)", 1),
                     _alike(key, of, F.regexp_replace(canon, "^(AKIA|[a-z]+[-_])", "")))))
        .when(kind == "iban", _iban(canon, plain))
        .otherwise(plain)
    )


def _laid_out(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the entity's own format: separators of numbers, capitals of addresses."""
    chars = F.split(entity, "")
    kept = F.when(kind == "iban", "[^ ]").otherwise("[0-9]")
    places = F.transform(chars, lambda c, i: F.size(F.filter(
        F.slice(chars, 1, i + 1), lambda x: F.regexp_like(x, kept))))
    spread = _joined(F.zip_with(chars, places, lambda c, p: F.when(
        F.regexp_like(c, kept), F.substring(surrogate, p, F.lit(1))).otherwise(c)))
    return (
        F.when(kind.isin("card", "phone", "ssn", "iban"), spread)
        .when((kind == "email") & (entity == F.upper(entity)) & entity.rlike("[A-Z]"), F.upper(surrogate))
        .otherwise(surrogate)
    )


def assign(found: DataFrame, key: str, max_attempts: int = 100) -> DataFrame:
    """From distinct (`kind`, `canon`) to distinct surrogates: (`kind`, `canon`, `surrogate`)."""
    found = found.withColumn("of", F.when(F.col("kind") == "name", family_of(F.col("canon"))))
    families = _settled(
        found.where("of IS NOT NULL").select(F.lit("family").alias("kind"), F.col("of").alias("canon")).distinct()
        .withColumn("family", F.lit(None).cast("string")), key, max_attempts)
    families = families.select(F.col("canon").alias("of"), F.col("surrogate").alias("family"))
    return _settled(found.join(families, "of", "left").select("kind", "canon", "family"), key, max_attempts)


def _settled(found: DataFrame, key: str, max_attempts: int) -> DataFrame:
    taken = None
    pending = materialize(found.withColumn("attempt", F.lit(0)), "entities")
    every = pending.select("kind", F.col("canon").alias("surrogate"))
    for _ in range(max_attempts):
        drawn = pending.withColumn("surrogate", F.when(
            F.col("kind") == "name", _name(key, F.col("canon"), F.col("attempt"), F.col("family")),
        ).otherwise(_surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"))))
        drawn = materialize(drawn, "drawn")
        # Of equal surrogates the smallest entity keeps it; grouping folds before the shuffle.
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        free = first.join(every, ["kind", "surrogate"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "surrogate"], "left_anti")
        won = materialize(free.select("kind", "canon", "surrogate"), "won")
        lost = drawn.join(won, ["kind", "canon"], "left_anti")
        pending = materialize(lost.select("kind", "canon", "family", (F.col("attempt") + 1).alias("attempt")), "pending")
        taken = won if taken is None else materialize(taken.unionByName(won), "taken")
        if pending.isEmpty():
            return taken
    # Only formats of fixed size come here, such as numbers of eleven digits: all are in use.
    raise RuntimeError("entities outnumber the surrogates of their format")


def replace_entities(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`row`, `text` with surrogates, and `n_entities` replaced (repeats included).

    `secret` keys the hashes: equal secrets give equal surrogates. No two entities of a type
    share a surrogate, and no surrogate is a found entity of its type. Texts without entities,
    empty and null texts stay as they are. Rows equal in key and text are replaced alike. An
    empty input gives no row.
    """
    body = F.col(text).cast("string")
    whole = packed(docs, key=F.col(key), body=F.md5(F.coalesce(body, F.lit("")).cast("binary")),
                   text=body, found=entities_of(F.coalesce(body, F.lit(""))))
    mentions = materialize(
        whole.select("key", "body", F.explode_outer(F.array_distinct("found")).alias("entity")).where("entity IS NOT NULL")
        .withColumn("kind", _kind(F.col("entity"))).withColumn("canon", _canonical(F.col("kind"), F.col("entity"))),
        "mentions")
    table = assign(mentions.select("kind", "canon").distinct(), secret)
    maps = (
        mentions.join(table, ["kind", "canon"])
        .select("key", "body", F.struct("entity", _laid_out(
            F.col("kind"), F.col("entity"), F.col("surrogate")).alias("by")).alias("pair"))
        .groupBy("key", "body").agg(F.map_from_entries(F.collect_set("pair")).alias("by"))
    )
    maps = materialize(maps, "replacements")
    pieces = F.split("text", ANY, -1)
    rebuilt = _joined(F.zip_with(pieces, "found", lambda p, e: F.concat(
        p, F.when(e.isNull(), "").otherwise(F.element_at("by", e)))))
    # Texts are shuffled once and searched again behind the join. The hint keeps the plan, and so
    # its cost per byte, the same however few texts have entities.
    whole = whole.select("row", "key", "body")
    on = reduce(lambda a, b: a & b, [whole["key"].eqNullSafe(maps["key"]), whole["body"] == maps["body"]])
    joined = whole.join(maps.hint("merge"), on, "left").select("row", "by", F.col(f"row.`{text}`").cast("string").alias("text"))
    joined = joined.withColumn("found", F.when(F.col("by").isNotNull(), entities_of(F.col("text"))))
    return joined.select(
        "row", F.when(F.col("by").isNull(), F.col("text")).otherwise(rebuilt).alias("text"),
        F.when(F.col("by").isNull(), 0).otherwise(F.size("found")).alias("n_entities"))
