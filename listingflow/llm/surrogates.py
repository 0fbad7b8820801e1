"""Personal data replaced by keyed surrogates of the same type and shape.

One pattern finds e-mail addresses, keys, account numbers, phone numbers, network addresses, card numbers, social
security numbers and titled names. Each is made of units (an address is one; of a name, given and family name are
one each, the title stays). A unit's canonical form is what makes two spellings the same: letters in lower case,
numbers without separators. It gets a surrogate from a keyed hash: digits for digits, letters for letters, a name of
the title's gender and of the name's script, a valid check digit where there was one. The surrogate then takes on
the spelling of each occurrence. Equal units get equal surrogates in the whole corpus, so references stay intact.

Collision check: a surrogate must differ from those of all other units of its kind, and from every unit that
itself occurs. Of units that claim the same surrogate the least keeps it; the others try again with the next attempt
number, until all are settled.

All of it is DataFrame functions. Units meet their surrogates through a join of distinct texts' units; texts without
any personal data are not shuffled, and texts that have some are shuffled once. Texts are told apart by their
digest, so copies are looked up once.

What is found: e-mail addresses; hexadecimal keys of 32 to 128 digits; IBANs; phone numbers with a leading +, with an
area code in brackets, in groups of 3-3-4 digits, or with a leading 0 and separators (9 to 12 digits); IPv4 and IPv6
addresses; card numbers of 13 to 19 digits; numbers of 3-2-4 digits; names of one or two words behind one or more of the
titles below. Not found: names without such a title, postal addresses, dates of birth, phone numbers without any
separator, + or bracket, IPv6 addresses without a decimal digit, and keys in other alphabets.

Defined cases: null texts stay null, texts without personal data stay byte for byte. Rows are kept one to one,
repeated or not, whatever their id; other columns pass through. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.session import materialize

# Titles with the gender they tell, names by gender and script, syllables by script.
MALE_TITLES = ("Mr", "Sir", "Lord", "Herr", "Señor", "Signor", "Monsieur", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Lady", "Madam", "Frau", "Fräulein", "Señora", "Señorita", "Signora", "Madame",
                 "Mademoiselle", "Госпожа")
OTHER_TITLES = ("Dr", "Doctor", "Prof", "Professor", "Rev", "Mx", "Доктор", "Профессор")
_ALL_TITLES = MALE_TITLES + FEMALE_TITLES + OTHER_TITLES
GIVEN_NAMES = {
    ("male", "latin"): ("adam", "carlos", "daniel", "erik", "felix", "henry", "jonas", "louis", "martin", "oscar", "peter", "thomas"),
    ("female", "latin"): ("anna", "clara", "diana", "elena", "emma", "julia", "laura", "maria", "nina", "paula", "sofia", "vera"),
    ("male", "cyrillic"): ("андрей", "борис", "виктор", "дмитрий", "иван", "максим", "николай", "павел", "сергей", "юрий"),
    ("female", "cyrillic"): ("анна", "вера", "дарья", "елена", "ирина", "мария", "наталья", "ольга", "софия", "татьяна"),
}
for _script in ("latin", "cyrillic"):
    GIVEN_NAMES["any", _script] = GIVEN_NAMES["male", _script] + GIVEN_NAMES["female", _script]
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ka", "ke", "ko", "la", "le", "lo",
              "ma", "me", "mo", "na", "ne", "no", "pa", "po", "ra", "re", "ro", "sa", "se", "so", "ta", "to"),
    "cyrillic": ("ба", "бе", "бо", "ва", "ве", "во", "га", "го", "да", "де", "до", "ка", "ко", "ла", "ле", "ло",
                 "ма", "ме", "мо", "на", "не", "но", "па", "по", "ра", "ре", "ро", "са", "се", "со", "та", "то"),
}
ENDINGS = {("male", "latin"): "n", ("female", "latin"): "na", ("male", "cyrillic"): "н", ("female", "cyrillic"): "на",
           ("any", "latin"): "s", ("any", "cyrillic"): "с", ("family", "latin"): "r", ("family", "cyrillic"): "в"}

_NAME = r"\p{Lu}\p{L}{1,30}"
_TITLES = "|".join(_ALL_TITLES)
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,10}[A-Za-z]{2,24}"
SECRET = r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])"
ACCOUNT = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
# Eight titles at most, and never given back: the search for a name stays short however often titles repeat.
_TITLE = rf"(?:{_TITLES})\.? (?=\p{{Lu}})"
_TITLED = rf"(?:{_TITLE}){{1,8}}+(?!{_TITLE})"
PERSON = rf"(?=[{''.join(sorted({t[0] for t in _ALL_TITLES}))}])(?<!\p{{L}}){_TITLED}{_NAME}(?: {_NAME})?"
PHONE = (r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
         r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|\(0[0-9]{1,4}\) ?[0-9]{3,8}(?:[ -][0-9]{2,4}){0,2}(?![0-9])")
ADDRESS = r"(?<![0-9]\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])"
SOCIAL = r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# Tried last. Dates, and groups that go on like an address or a longer number, are none.
NATIONAL = (r"(?<![0-9][.-])(?:(?:1[ .-])?(?:[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}|[0-9]{3} [0-9]{3} [0-9]{4})"
            r"|(?!0[0-9][./-][0-9]{2}[./-][0-9]{4}(?![0-9]))(?=0(?:[ ./-]?[0-9]){8,11}(?![0-9]))"
            r"0[0-9]{1,4}(?:[ ./-][0-9]{2,8}){1,4})(?![0-9]|[.-][0-9])")
_HEX = r"[0-9A-Fa-f]{1,4}"
_QUAD = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
ADDRESS_6 = (rf"(?=[0-9A-Fa-f]{{0,4}}:)(?=[A-Fa-f:]*[0-9])(?<!:)"
             rf"(?:(?:(?:{_HEX}:){{6}}|(?:{_HEX}(?::{_HEX}){{0,4}})?::(?:{_HEX}:){{0,5}}){_QUAD}"
             rf"|(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![0-9A-Za-z:])")
CARD = r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
# One look back per character decides whether a word begins; all else is tried only there, or at a digit, + or (.
PATTERN = (rf"(?<![A-Za-z0-9])(?:{EMAIL}|{SECRET}|{ACCOUNT}|{PERSON}|{ADDRESS_6})"
           rf"|(?=[0-9+(])(?<![0-9])(?:{PHONE}|{ADDRESS}|{SOCIAL}|{CARD}|{NATIONAL})")
# Every match has one of these. Plain searches for them are far cheaper than the pattern, so it is tried only after.
_TITLE_STEMS = tuple(t for t in _ALL_TITLES if not any(t != u and t.startswith(u) for u in _ALL_TITLES))
_HINTS = tuple("@0123456789") + _TITLE_STEMS

_DIGITS_ONLY = ("phone", "social", "card")


def _all(pattern: str) -> str:
    return rf"^(?:{pattern})$"


def _kind(raw: Column) -> Column:
    """Kind of a whole match, by the first pattern that it is an instance of. Context plays no part here."""
    return (
        F.when(raw.contains("@"), "email")
        .when(raw.contains(":"), "address6")
        .when(raw.rlike(_all("[0-9a-f]{32,128}|[0-9A-F]{32,128}")), "secret")
        .when(raw.rlike(r"^[A-Z]{2}[0-9]{2}"), "account")
        .when(raw.rlike(r"^[+(]"), "phone")
        .when(raw.rlike(_all(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}")), "address")
        .when(raw.rlike(_all(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")), "social")
        .when(raw.rlike(r"^[0-9]"), F.when(F.length(F.regexp_replace(raw, "[^0-9]", "")) < 13, "phone").otherwise("card"))
        .otherwise("person")
    )


def entities(text: Column) -> Column:
    """All matches in the text, in order."""
    return F.regexp_extract_all(text, F.lit(f"({PATTERN})"), F.lit(1))


def _units(found: DataFrame) -> DataFrame:
    """One row per unit of the matches (digest, place, raw): sub, lead (text kept before it), kind, unit."""
    kind = _kind(F.col("raw"))
    titles = F.regexp_extract("raw", rf"^{_TITLED}(?=\p{{Lu}})", 0)
    name = F.split(F.substr("raw", F.length(titles) + 1), " ")

    def titled(known):
        return titles.rlike(rf"(?<!\p{{L}})(?:{'|'.join(known)})(?!\p{{L}})")

    gender = F.when(titled(MALE_TITLES), "male").when(titled(FEMALE_TITLES), "female").otherwise("any")

    def unit(lead, kind, value):
        return F.struct(lead.alias("lead"), kind.alias("kind"), value.alias("unit"))

    family = F.element_at(name, -1)
    units = F.when(kind != "person", F.array(unit(F.lit(""), kind, F.col("raw")))).when(
        F.size(name) == 1, F.array(unit(titles, F.lit("family"), family))
    ).otherwise(F.array(
        unit(titles, gender, F.get(name, F.lit(0))), unit(F.lit(" "), F.lit("family"), family)
    ))
    return found.select("digest", "place", F.posexplode(units).alias("sub", "u")).select(
        "digest", "place", "sub", "u.lead", "u.kind", "u.unit"
    )


def _canonical(kind: Column, unit: Column) -> Column:
    return (
        F.when(kind.isin(*_DIGITS_ONLY), F.regexp_replace(unit, "[^0-9]", ""))
        .when(kind == "account", F.lower(F.replace(unit, F.lit(" "), F.lit(""))))
        .when((kind == "address6") & ~unit.contains("."), _groups_of_four(F.lower(unit)))
        .otherwise(F.lower(unit))
    )


def _groups_of_four(address: Column) -> Column:
    """An IPv6 address with all eight groups of four digits."""
    def groups(part):
        return F.transform(F.filter(F.split(part, ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0"))

    left = groups(F.substring_index(address, "::", 1))
    right = F.when(address.contains("::"), groups(F.substring_index(address, "::", -1))).otherwise(F.slice(left, 1, 0))
    zeros = F.array_repeat(F.lit("0000"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.concat(left, zeros, right), ":")


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i, F.lit(1)))


def _byte(digest: Column, i: Column) -> Column:
    """Byte ``i``, counted from 0 and around, of a digest of 64 hexadecimal digits."""
    return F.conv(F.substr(digest, 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int")


def _letter(alphabet: str, number: Column) -> Column:
    return F.substr(F.lit(alphabet), number % len(alphabet) + 1, F.lit(1))


def _shaped(text: Column, digest: Column) -> Column:
    """Digits for digits, letters for letters, all else kept."""
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    return F.array_join(F.transform(_chars(text), lambda c, i: (
        F.when(c.between("0", "9"), _letter(digits, _byte(digest, i)))
        .when(c.between("a", "z"), _letter(letters, _byte(digest, i))).otherwise(c)
    )), "")


def _luhn_sum(digits: Column) -> Column:
    """The check sum of a card number."""
    def weighed(c, i):
        d = c.cast("int")
        twice = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - i) % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.transform(_chars(digits), weighed), F.lit(0), lambda a, d: a + d)


def _card(number: Column, digest: Column) -> Column:
    """First digit kept; the check digit is right exactly where it was."""
    body = F.concat(F.substr(number, F.lit(1), F.lit(1)),
                    _shaped(F.substr(number, F.lit(2), F.length(number) - 2), digest))
    right = (10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    wrong = (right + 1 + _byte(digest, F.lit(31)) % 9) % 10
    return F.concat(body, F.when(_luhn_sum(number) % 10 == 0, right).otherwise(wrong).cast("string"))


def _address(address: Column, digest: Column) -> Column:
    """Private networks stay private."""
    private = F.regexp_extract(address, r"^(10\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)", 1)
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(
        i == 0, 1 + _byte(digest, i) % 223).otherwise(_byte(digest, i)).cast("string")), ".")
    skip = F.size(F.split(private, r"\.")) - 1
    tail = F.array_join(F.slice(F.split(octets, r"\."), skip + 1, F.lit(4)), ".")
    return F.concat(private, tail)


def _address_6(address: Column, digest: Column) -> Column:
    """Private and link-local networks keep their first group, all others become global ones."""
    first = F.when(address.rlike("^f[cde]"), F.substr(address, F.lit(1), F.lit(4))).otherwise(
        F.concat(F.lit("2"), F.substr(digest, F.lit(2), F.lit(3))))
    return F.concat(first, F.regexp_replace(F.substr(digest, F.lit(5), F.lit(28)), "(.{4})", ":$1"))


def _made_up(syllables: tuple[str, ...], ending: str, digest: Column, n: Column) -> Column:
    known = F.array(*(F.lit(s) for s in syllables))
    return F.concat(F.array_join(F.transform(
        F.sequence(F.lit(1), n), lambda i: F.get(known, _byte(digest, i) % len(syllables))
    ), ""), F.lit(ending))


def _name(kind: Column, canonical: Column, digest: Column, attempt: Column) -> Column:
    """From the list first, then made up of syllables, one more every fourth attempt."""
    n = (3 + attempt / 4).cast("int")
    out = F.lit(None).cast("string")
    for script in ("latin", "cyrillic"):
        here = canonical.rlike(r"\p{IsCyrillic}") if script == "cyrillic" else ~canonical.rlike(r"\p{IsCyrillic}")
        out = F.when(here & (kind == "family"), _made_up(SYLLABLES[script], ENDINGS["family", script], digest, n)).otherwise(out)
        for gender in ("male", "female", "any"):
            listed = GIVEN_NAMES[gender, script]
            known = F.get(F.array(*(F.lit(x) for x in listed)), _byte(digest, F.lit(0)) % len(listed))
            made = _made_up(SYLLABLES[script], ENDINGS[gender, script], digest, n)
            out = F.when(here & (kind == gender), F.when(attempt == 0, known).otherwise(made)).otherwise(out)
    return out


def _surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    def keyed(*parts):
        return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts, F.lit(key)), 256)

    digest = keyed(kind, attempt.cast("string"), canonical)
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    last = F.concat(F.lit("."), F.substring_index(domain, ".", -1))
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(last))
    # Addresses at one host stay at one host.
    email = F.concat(_shaped(local, digest), F.lit("@"), _shaped(host, keyed(F.lit("host"), host)), last)
    prefix = F.when(F.length(canonical) > 10, F.length(canonical) - 10).otherwise(0)  # country code
    prefix = F.greatest(prefix, F.when(canonical.startswith("0"), 1).otherwise(0))  # trunk prefix
    secret = F.array_join(F.transform(_chars(canonical), lambda c, i: _letter("0123456789abcdef", _byte(digest, i))), "")
    # Beyond 32 characters the digest repeats, so the second half is shifted by another one.
    other = keyed(kind, attempt.cast("string"), canonical, F.lit("more"))
    long_secret = F.when(F.length(canonical) > 32, F.concat(
        F.substr(secret, F.lit(1), F.lit(32)),
        F.array_join(F.transform(_chars(F.substr(canonical, F.lit(33), F.length(canonical) - 32)),
                                 lambda c, i: _letter("0123456789abcdef", _byte(other, i))), ""),
    )).otherwise(secret)
    return (
        F.when(kind == "email", email)
        .when(kind == "secret", long_secret)
        .when(kind == "account", F.concat(F.substr(canonical, F.lit(1), F.lit(2)),
                                          _shaped(F.substr(canonical, F.lit(3), F.length(canonical)), digest)))
        .when(kind == "phone", F.concat(F.substr(canonical, F.lit(1), prefix),
                                        _shaped(F.substr(canonical, prefix + 1, F.length(canonical)), digest)))
        .when(kind == "address", _address(canonical, digest))
        .when(kind == "address6", _address_6(canonical, digest))
        .when(kind == "card", _card(canonical, digest))
        .when(kind == "social", _shaped(canonical, digest))
        .otherwise(_name(kind, canonical, digest, attempt))
    )


def _spelled(kind: Column, unit: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of one occurrence."""
    def nth(i, kept):
        return F.length(F.regexp_replace(F.substr(unit, F.lit(1), i + 1), kept, ""))

    separated = F.array_join(F.transform(_chars(unit), lambda c, i: F.when(
        c.between("0", "9"), F.substr(surrogate, nth(i, "[^0-9]"), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(_chars(unit), lambda c, i: F.when(
        c != " ", F.upper(F.substr(surrogate, nth(i, " "), F.lit(1)))).otherwise(c)), "")
    cased = F.array_join(F.transform(_chars(unit), lambda c, i: F.when(
        c.between("A", "Z"), F.upper(F.substr(surrogate, i + 1, F.lit(1)))).otherwise(F.substr(surrogate, i + 1, F.lit(1)))), "")
    return (
        F.when(kind.isin(*_DIGITS_ONLY), separated)
        .when(kind == "account", spaced)
        .when(kind.isin("email", "secret"), cased)
        .when(kind.isin("address", "address6"), surrogate)
        .when(unit == F.upper(unit), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    )


def assign(units: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) of the distinct units (kind, canonical), all surrogates different per kind."""
    units = materialize(units.distinct(), "units")
    open_, settled, attempt = units, None, 0
    while True:
        tried = open_.withColumn(
            "surrogate", _surrogate(key, F.col("kind"), F.col("canonical"), F.lit(attempt))
        )
        # A surrogate that occurs as a unit, or is taken, is refused; of several claims the least unit's holds.
        taken = units.select("kind", F.col("canonical").alias("surrogate"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "surrogate"))
        claims = tried.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        won = materialize(
            claims.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canonical", "surrogate"),
            "surrogates",
        )
        settled = won if settled is None else settled.unionByName(won)
        rest = materialize(open_.join(won.select("kind", "canonical"), ["kind", "canonical"], "left_anti"), "refused")
        if rest.isEmpty():
            return settled
        open_, attempt = rest, attempt + 1


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_replaced``; the key decides the surrogates."""
    text = docs["text"].cast("string")
    hinted = reduce(or_, (text.contains(h) for h in _HINTS))
    has = F.coalesce(F.when(hinted, text.rlike(PATTERN)), F.lit(False))
    digest = F.sha2(text, 256)
    found = materialize(
        docs.where(has).select(digest.alias("digest"), entities(text).alias("found"))
        .groupBy("digest").agg(F.first("found").alias("found")),
        "private-matches",
    )
    units = _units(found.select("digest", F.posexplode("found").alias("place", "raw"))).withColumn(
        "canonical", _canonical(F.col("kind"), F.col("unit"))
    )
    units = materialize(units, "private-units")
    surrogates = assign(units.select("kind", "canonical"), key)
    spelled = F.concat("lead", _spelled(F.col("kind"), F.col("unit"), F.col("surrogate")))
    replaced = (
        units.join(materialize(surrogates, "assigned"), ["kind", "canonical"])
        .select("digest", "place", "sub", spelled.alias("new"))
        .groupBy("digest", "place")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sub", "new"))), lambda s: s["new"]), "").alias("new"))
        .groupBy("digest")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "new"))), lambda s: s["new"]).alias("_news"))
        .withColumnRenamed("digest", "_digest")
    )
    replaced = materialize(replaced, "replacements")
    columns = [docs[c] for c in docs.columns if c not in ("text", "n_replaced")]
    pieces = F.split(text, PATTERN, -1)
    # As many pieces as replacements and one more; the last one has no replacement.
    rebuilt = F.array_join(F.zip_with(pieces, replaced["_news"], lambda p, new: F.concat(p, F.coalesce(new, F.lit("")))), "")
    with_data = docs.where(has).join(replaced, digest == replaced["_digest"]).select(
        *columns, rebuilt.alias("text"), F.size(replaced["_news"]).cast("long").alias("n_replaced")
    )
    without = docs.where(~has).select(*columns, text.alias("text"), F.lit(0).cast("long").alias("n_replaced"))
    return without.unionByName(with_data)
