"""Personal data: each detected entity gets a keyed surrogate of its own kind.

Detection is one alternation of patterns, each match classified and checked (addresses by
their ranges).  Cards are looked for first, at the start of each group of digits, and
only numbers whose check digit fits enter the text's alternation, behind social security and phone
numbers: what is no card hides nothing that stands in or beside it.  Replacement
cuts the text at the matches and joins it again around the surrogates, so that
only the matched characters change.

Surrogates depend on the key, the kind and the entity's canonical form alone (case
of an address, spacing of a number do not matter), so one entity has one surrogate
in all texts: coreference holds without any table.  They keep the form:
- numbers (phone, card, social security): a keyed Feistel permutation of
  the digits, written into the entity's own punctuation.  A card keeps its first
  digit and gets a valid check digit, a phone number keeps its country code (after a ``+`` by the numbering plan);
- bank accounts: country and length stay, digits and letters are turned each among themselves, the check digits fit;
  the spacing is the entity's own and plays no part;
- addresses of machines: a keyed permutation of the bits; those of private networks stay in their network, public
  ones stay public;
- secrets: character by character within hexadecimal, digits, small and capital letters;
- mail: the local part character by character, the domain label by label, under the
  reserved top-level name ``example``;
- names after a title: all words of the name, the last as family name and those before as given
  names, each one of like script, gender (told by the title) and capitals; particles stay and
  initials get other letters; a family name has one surrogate with or without given names.
A permutation gives different entities of one form different surrogates.

Collision check.  All distinct entities of the corpus are gathered (kind and
canonical form, of names each family and given name; pre-aggregated, so a hot entity is one row a task) and their
surrogates counted.  Of entities that share a surrogate all but one, and those whose
surrogate is an entity of the corpus itself, try again with the next number, until
none is left.  Only these exceptions are looked up when texts are replaced.

Only column expressions and joins are used.

Defined cases: a null text stays null, with no entities; an empty one stays empty;
repeated rows change alike; texts without entities come back as they were.
Extra columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import checkpointed, let, others, quoted

# Titles by the gender they tell ('' where they tell none).
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"),
    "": ("Dr", "Prof"),
}
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_FIRST = "".join(sorted({t[0] for ts in TITLES.values() for t in ts}))
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_LABEL = r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']? ?[:=] ?[\"']?"
_END = r"(?![\p{L}\p{N}])"
#: Numbers of a grouping of their own: social security, phone, card.
_APART = r"(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|(?:1[ .-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\p{L}\p{N}-])"
_NEXT = rf"(?:{_APART}|(?:[0-9]{{4}}[ -]){{3}}[0-9]{{4}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{4,5}}|[0-9]{{13,19}}){_END}"
_LOCAL = r"[\p{L}\p{N}._%+-]"
#: Particles of names stay as they are.
PARTICLES = ("von", "vom", "van", "der", "den", "dem", "de", "del", "della", "dei", "des", "di", "da", "dal", "das", "do",
             "dos", "du", "la", "le", "las", "los", "el", "al", "bin", "bint", "ibn", "ben", "zu", "zum", "zur", "ter", "ten",
             "te", "y", "e", "und", "af", "av", "фон", "де", "ван")
_PARTICLES = rf"(?:(?:{'|'.join(PARTICLES)}) )*+"
#: A name of two letters or more, initials joined to it included; initials on their own; an initial that ends a name.
_WORD = r"(?:\p{Lu}\.)*+\p{Lu}[\p{L}\p{M}'’-]++"
_INITIAL = r"(?:(?:\p{Lu}\.)++|\p{Lu}(?![\p{L}\p{M}'’.-]))"
_LAST = r"(?![AI](?!\.))\p{Lu}(?:\.\p{Lu})*+(?![\p{L}\p{M}'’-])"

#: What may be an entity, in the order of the alternation: kind, pattern, what must not follow.
#: All start where no letter or digit stands before.  No pattern has an upper bound that would cut
#: an entity; loops without a bound are possessive or over one character, so that long texts take
#: neither stack nor quadratic time (a mail address is tried once a run of its characters, and
#: behind each match).  Over 128 times the same digit is no secret.
PATTERNS = [
    ("secret", rf"{_LABEL}[^\s\"']{{7,}}[^\s\"'.,;:!?)]", ""),
    ("address", rf"(?<![0-9]\.){_OCTET}(?:\.{_OCTET}){{3}}", r"(?![\p{L}\p{N}]|\.[0-9])"),
    ("social", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?![\p{L}\p{N}-])"),
    ("phone", r"(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}", _END),
    ("phone", rf"\+[0-9]{{1,3}}[ .-]?[0-9]{{1,4}}[ .-]?[0-9]{{2,4}}(?:(?! {_NEXT})[ .-]?[0-9]{{2,4}}){{0,3}}", _END),
    ("phone", r"(?:1[ .-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}", r"(?![\p{L}\p{N}-])"),
    ("card", r"[0-9](?:[ -]?[0-9]){12,18}", _END),
    ("secret", rf"(?:(?!(?<one>[0-9])\k<one>{{128,}}+{_END})(?:[0-9a-f]{{32,}}+|[0-9A-F]{{32,}}+)|AKIA[0-9A-Z]{{16}}"
               r"|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+)", _END),
    ("account", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?", _END),
    ("name", rf"(?=[{_FIRST}])(?:{_TITLE})\.? (?:{_INITIAL} )*+{_PARTICLES}{_WORD}(?: {_PARTICLES}{_WORD}| {_INITIAL}(?= {_PARTICLES}\p{{Lu}})"
             rf"| {_LAST})*+", ""),
    ("mail", rf"(?:(?<!{_LOCAL})|\G|(?<=\G[._%+-])){_LOCAL}++@(?:(?:[\p{{L}}\p{{N}}-]++\.(?=[\p{{L}}\p{{N}}-]++\.|\p{{L}}{{2}}))++"
             r"\p{L}{2,}+|(?:[\p{L}\p{N}-]{1,63}+\.){1,8}\p{L}{2,24}+)", ""),
]
_BEFORE = r"(?<![\p{L}\p{N}])"
_CARD = next(p for kind, p, _ in PATTERNS if kind == "card")
_MORE = rf"[0-9](?:(?![ -]{_APART})[ -]?[0-9])"
#: What may be a card: digits to the end of their run; the usual groupings wherever they stand; other
#: digits, as many as there are, or of the usual lengths.
CARDS = [rf"{_BEFORE}(?=({_CARD})(?![\p{{L}}\p{{N}}]|[ -][0-9]))",
         rf"{_BEFORE}(?=([0-9]{{13,19}}|[0-9]{{4}}([ -])[0-9]{{4}}\2[0-9]{{4}}\2[0-9]{{4}}"
         rf"|[0-9]{{4}}([ -])[0-9]{{6}}\3[0-9]{{4,5}}){_END})",
         *[rf"{_BEFORE}(?=({_MORE}{{{n}}}){_END})" for n in ("12,18", "15", "14")]]


def pattern(text: Column) -> Column:
    """The alternation for a text; its cards are those numbers in it whose last digit fits, so that
    digits which are no card are left to the other patterns and to cards that begin later."""
    def every(card: str) -> str:
        return f"{_BEFORE}(?:" + "|".join(f"{card if kind == 'card' else p}{end}" for kind, p, end in PATTERNS) + ")"

    # the sign between the halves stands in no pattern
    before, behind = every("\0").split("\0")
    maybe = F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in CARDS]))
    valid = F.filter(maybe, lambda c: _check_digit(F.regexp_replace(c, "[^0-9]", "")) & ~c.rlike(_BEFORE + _APART))
    with_cards = let(valid, lambda cards: F.when(F.size(cards) > 0, F.concat(
        F.lit(f"{before}(?={_CARD})(?:"), F.array_join(cards, "|"), F.lit(f"){behind}"))))
    return F.coalesce(F.when(text.rlike(_CARD), with_cards), F.lit(every("(?!)")))


#: No entity without one of these: most texts need no more than this look.  Secrets alone can be
#: without a digit, sign or title; their own beginnings stand here.
HINT = rf"[0-9@:=]|AKIA|gh[pousr]_|sk-|[a-f]{{32}}|[A-F]{{32}}|(?=[{_FIRST}])(?:{_TITLE})\b"
HEX = "0123456789abcdef"
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"

MENTION = "struct<kind:string,canonical:string,found:string>"


def kind_of(found: Column) -> Column:
    """The kind of a match, or null if a check shows that it is none."""
    out = F.when(found.rlike(rf"\A(?:{PATTERNS[0][1]})\z"), PATTERNS[0][0])
    for kind, pattern, _ in PATTERNS[1:]:
        hit = found.rlike(rf"\A(?:{pattern})\z")
        valid = _check_digit(F.regexp_replace(found, "[^0-9]", "")) if kind == "card" else F.lit(True)
        out = out.when(hit, F.when(valid, kind))
    return out


def _check_digit(digits: Column) -> Column:
    """Does the last digit fit (every second digit from the right doubled)?"""
    return _luhn_sum(digits) % 10 == 0


def _luhn_sum(digits: Column) -> Column:
    """The weighted digit sum, the last digit with weight one."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(d == "", 0).otherwise(let(
        d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x))))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def canonical(kind: Column, found: Column) -> Column:
    return F.when(kind == "mail", F.lower(found)) \
        .when(kind == "phone", F.regexp_replace(found, r"(?!\A\+)[^0-9]", "")) \
        .when(kind.isin("card", "social"), F.regexp_replace(found, "[^0-9]", "")) \
        .when(kind == "account", F.regexp_replace(found, " ", "")) \
        .when(kind == "secret", F.regexp_replace(found, rf"\A{_LABEL}", "")) \
        .otherwise(found)


def mentions(text: Column) -> Column:
    """Array of the matches in order, each a struct of kind (null: none), canonical and found."""
    def mention(found: Column) -> Column:
        return let(kind_of(found), lambda k: F.struct(k.alias("kind"), canonical(k, found).alias("canonical"),
                                                      found.alias("found")))

    every = F.transform(F.regexp_extract_all(text, pattern(text), F.lit(0)), mention)
    return F.when(text.rlike(HINT), every).otherwise(F.array().cast(f"array<{MENTION}>"))


# -- surrogates ------------------------------------------------------------------------------

def _number(key: Column, i, modulus) -> Column:
    """A keyed number below ``modulus`` (at most 10**9)."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", key, i), 256), 1, 14), 16, 10).cast("long") % modulus


def _permuted_digits(digits: Column, key: Column) -> Column:
    """A keyed permutation of the numbers with as many digits (six Feistel rounds on two halves)."""
    def power(n: Column) -> Column:
        return F.rpad(F.lit("1"), n + 1, "0").cast("decimal(38,0)")

    def rounds(s: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(5)), s, lambda s, r: F.when(
            r % 2 == 0, F.struct(_turned(s["a"], s["b"], r, key, power).alias("a"), s["b"].alias("b")))
            .otherwise(F.struct(s["a"].alias("a"), _turned(s["b"], s["a"], r, key, power).alias("b"))))

    def halves(digits: Column) -> Column:
        half = (F.char_length(digits) / 2).cast("int")
        return F.struct(F.substr(digits, F.lit(1), half).alias("a"), F.substr(digits, half + 1).alias("b"))

    return let(rounds(let(digits, halves)), lambda s: F.concat(s["a"], s["b"]))


def _turned(half: Column, other: Column, r: Column, key: Column, power) -> Column:
    n = F.char_length(half)
    add = F.conv(F.substring(F.sha2(F.concat_ws("|", key, r, n, other), 256), 1, 14), 16, 10).cast("decimal(38,0)")
    turned = F.pmod(half.cast("decimal(38,0)") + add, power(n))
    return F.when(n == 0, half).otherwise(F.lpad(turned.cast("string"), n, "0"))


def _written_into(found: Column, digits: Column, signs: str = "[0-9]") -> Column:
    """``found`` with its digits (or other ``signs``) replaced in order."""
    gaps = F.split(found, signs, -1)
    return F.array_join(F.zip_with(gaps, F.split(digits, ""), lambda g, d: F.concat(F.coalesce(g, F.lit("")),
                                                                                   F.coalesce(d, F.lit("")))), "")


def _turned_letters(s: Column, key: Column, hexadecimal: bool = True) -> Column:
    """Each character replaced by another of its class: digit, small, capital, Cyrillic; hexadecimal
    strings stay so (unless they are something else); other characters stay."""
    def stream(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), (F.char_length(s) / 32).cast("int")),
                           lambda b: F.sha2(F.concat_ws("|", key, b), 256))

    def step(i: Column, keys: Column) -> Column:
        return F.conv(F.substring(F.get(keys, (i / 32).cast("int")), i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def turned(c: Column, step: Column, is_hex: Column) -> Column:
        def within(alphabet: str, c: Column) -> Column:
            return F.substring(F.lit(alphabet), (F.instr(F.lit(alphabet), c) - 1 + step) % len(alphabet) + 1, F.lit(1))

        def cased(alphabet: str) -> Column:
            low = F.lower(c)
            return F.when(c == low, within(alphabet, low)).otherwise(F.upper(within(alphabet, low)))

        return (F.when(is_hex & c.rlike("[0-9]"), within(HEX, c)).when(is_hex, within(HEX, F.lower(c)))
                .when(c.rlike("[0-9]"), within("0123456789", c))
                .when(c.rlike("[A-Za-z]"), cased("abcdefghijklmnopqrstuvwxyz"))
                .when(F.instr(F.lit(CYRILLIC), F.lower(c)) > 0, cased(CYRILLIC))
                .when(c.rlike(r"\p{L}"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), step % 26 + 1, F.lit(1)))
                .otherwise(c))

    def whole(s: Column, keys: Column, is_hex: Column) -> Column:
        each = F.transform(F.filter(F.split(s, ""), lambda c: c != ""),
                           lambda c, i: let(step(i, keys), lambda n: turned(c, n, is_hex)))
        return let(F.array_join(each, ""), lambda out: F.when(is_hex & s.rlike("[A-F]"), F.upper(out)).otherwise(out))

    def hexa(s: Column) -> Column:
        return s.rlike(r"\A(?:[0-9a-f]{16,}|[0-9A-F]{16,})\z") if hexadecimal else F.lit(False)

    return let(s, lambda s: let(stream(s), lambda keys: let(hexa(s), lambda h: whole(s, keys, h))))


# What surrogate names are made of; Cyrillic letters stand below their Latin ones.
SYLLABLES = ("ba", "be", "bo", "da", "de", "di", "do", "fa", "fe", "fi", "ga", "go", "ka", "ke", "ki", "la",
             "le", "li", "lo", "ma", "me", "mi", "mo", "na", "ne", "no", "ra", "re", "ri", "ro", "sa", "se",
             "si", "so", "ta", "te", "ti", "to", "va", "ve", "vi", "za", "ze", "zo")
LATIN_SIDE, CYRILLIC_SIDE = "abdefgiklmnorstvz", "абдефгиклмнорствз"


def _stem(token: Column, role: Column, key: str, attempt: Column) -> Column:
    """Small syllables for a name in its script; each attempt has one more, so that the space grows."""
    n = F.least(F.greatest(F.lit(3), (F.char_length(token) / 2).cast("int")), F.lit(20)) + attempt
    base = F.concat_ws("|", F.lit(key), attempt, role, F.lower(token))
    stem = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.get(
        F.array(*map(F.lit, SYLLABLES)), _number(base, i, len(SYLLABLES)).cast("int"))), "")
    return F.when(token.rlike(r"\p{IsCyrillic}"), F.translate(stem, LATIN_SIDE, CYRILLIC_SIDE)).otherwise(stem)


def _name(token: Column, role: Column, gender: Column, key: str, attempt: Column) -> Column:
    """A name for one name: its stem, an ending by gender for given names, script and capitals kept."""
    end = F.when(role == "family", "r").when(gender == "f", "na").when(gender == "m", "n").otherwise("s")
    end = F.when(token.rlike(r"\p{IsCyrillic}"), F.translate(end, LATIN_SIDE, CYRILLIC_SIDE)).otherwise(end)
    return let(F.concat(_stem(token, role, key, attempt), end), lambda name: F.when(
        token.rlike(r"\A\p{Lu}{2,}\z"), F.upper(name)).otherwise(F.initcap(name)))


def _stem_of(token: Column, role: Column) -> Column:
    """The stem that a name of the corpus would be made of (null: none)."""
    found = F.when(role == "family", F.regexp_extract(token, r"\A(.+)[rр]\z", 1)).otherwise(
        F.regexp_extract(token, r"\A(.+?)(?:na|на|[nsнс])\z", 1))
    return F.when(found != "", found)


def _name_words(found: Column) -> Column:
    """The words of a match of kind name, its title left out."""
    return F.split(F.regexp_replace(found, rf"\A(?:{_TITLE})\.? ", ""), " ")


def _role(i: Column, words: Column) -> Column:
    return F.when(i == F.size(words) - 1, "family").otherwise("given")


def entities_of(kind: Column, canonical: Column) -> Column:
    """What has a surrogate of its own in a match, as structs of kind and canonical: of a name each
    family and given name in small letters, otherwise the match."""
    one = F.array(F.struct(kind.alias("kind"), canonical.alias("canonical")))
    names = let(_name_words(canonical), lambda words: F.filter(F.transform(words, lambda word, i: F.when(
        ~word.rlike(LOWER_WORD) & ~word.rlike(INITIALS),
        F.struct(_role(i, words).alias("kind"), F.lower(word).alias("canonical")))), lambda e: e.isNotNull()))
    return F.when(kind == "name", names).otherwise(one)


#: Words of a name that are none to replace, and initials.
LOWER_WORD, INITIALS = r"\A\p{Ll}", r"\A\p{Lu}(?:\.\p{Lu})*\.?\z"


def _turned_initials(token: Column, key: str) -> Column:
    """Other initials: a keyed turn of the alphabet, the same one in all texts; X for letters of neither script."""
    def turned(alphabet: str) -> str:
        by = 1 + int(hashlib.sha256(f"{key}|initial".encode()).hexdigest(), 16) % (len(alphabet) - 1)
        return alphabet[by:] + alphabet[:by]

    latin, cyrillic = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", CYRILLIC.upper()
    return F.translate(F.regexp_replace(token, rf"[\p{{Lu}}&&[^A-Z{cyrillic}]]", "X"), latin + cyrillic,
                       turned(latin) + turned(cyrillic))


def name_surrogate(found: Column, key: str, attempt: Callable[[Column, Column], Column]) -> Column:
    """What replaces a name; ``attempt`` gives that of a role and a word."""
    title = F.regexp_extract(found, rf"\A({_TITLE})\.?", 0)

    def gender(bare: Column) -> Column:
        return F.when(bare.isin(*TITLES["f"]), "f").when(bare.isin(*TITLES["m"]), "m").otherwise("")

    def made(word: Column, role: Column, told: Column) -> Column:
        return F.when(word.rlike(LOWER_WORD), word).when(word.rlike(INITIALS), _turned_initials(word, key)).otherwise(
            let(attempt(role, word), lambda n: _name(word, role, told, key, n)))

    return let(_name_words(found), lambda words: let(let(F.regexp_replace(title, r"\.", ""), gender), lambda told: F.concat_ws(
        " ", title, F.transform(words, lambda word, i: let(_role(i, words), lambda role: made(word, role, told))))))


# Country codes of one and of two digits (all others have three).
COUNTRY_1, COUNTRY_2 = "[17]", "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
# Networks that are not public: first octets, and the bits behind them.
PRIVATE = [(r"10\.", 24), (r"127\.", 24), (r"172\.(?:1[6-9]|2[0-9]|3[01])\.", 20), (r"192\.168\.", 16), (r"169\.254\.", 16)]


def _account(found: Column, key: str, attempt: Column) -> Column:
    """A bank account in its own spacing: country and length stay, the rest is turned by kind of character, and the
    two check digits fit."""
    def rest(s: Column) -> Column:
        """The remainder by 97 of a text whose letters count from 10 (A) to 35 (Z)."""
        return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), F.lit(0), lambda r, c: F.when(
            c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97))

    def made(plain: Column) -> Column:
        country = F.substring(plain, 1, 2)
        turned = _turned_letters(F.substr(plain, F.lit(5)), F.concat_ws("|", F.lit(key), F.lit("account"), attempt, plain),
                                 hexadecimal=False)
        return let(turned, lambda t: _written_into(found, F.concat(country, F.lpad(
            (98 - rest(F.concat(t, country, F.lit("00")))).cast("string"), 2, "0"), t), "[A-Z0-9]"))

    return let(F.regexp_replace(found, " ", ""), made)


def _address(found: Column, base: Column) -> Column:
    """A keyed permutation of the addresses of a network: those of a private one stay in it, public ones stay public."""
    octets = F.split(found, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda n, o: n * 256 + o.cast("long"))
    bits = F.lit(32)
    for start, behind in PRIVATE:
        bits = F.when(found.rlike(rf"\A{start}"), F.lit(behind)).otherwise(bits)

    def text(n: Column) -> Column:
        return F.concat_ws(".", *[(F.shiftright(n, k).bitwiseAND(F.lit(255))).cast("string") for k in (24, 16, 8, 0)])

    def permuted(n: Column, half: Column) -> Column:
        """Six Feistel rounds on the last 2 * half bits."""
        def of(low: Column, mask: Column) -> Column:
            def turn(s: Column, r: Column) -> Column:
                return F.struct(s["b"].alias("a"), s["a"].bitwiseXOR(_number(F.concat_ws("|", base, half, s["b"]), r, 65536) % mask).alias("b"))

            halves = F.struct((low / mask).cast("long").alias("a"), (low % mask).alias("b"))
            return let(F.aggregate(F.sequence(F.lit(0), F.lit(5)), halves, turn), lambda s: n - low + s["a"] * mask + s["b"])

        return let(F.pow(F.lit(2.0), half).cast("long"), lambda mask: let(n % (mask * mask), lambda low: of(low, mask)))

    special = "|".join(start for start, _ in PRIVATE)
    # a public address that becomes a private one goes on; eight times in a row does not happen
    return let(F.struct(number.alias("n"), (bits / 2).cast("int").alias("half")), lambda x: text(F.aggregate(
        F.sequence(F.lit(1), F.lit(8)), permuted(x["n"], x["half"]),
        lambda n, _: F.when((x["half"] == 16) & text(n).rlike(rf"\A(?:{special})"), permuted(n, x["half"])).otherwise(n))))


def surrogate(kind: Column, found: Column, key: str, attempt: Column) -> Column:
    """What replaces a match; ``attempt`` counts collisions, 0 for almost all.

    What several kinds use is bound by ``let``: written out at each place, it would stand in the plan many thousand times."""
    def phone(digits: Column, base: Column) -> Column:
        country = F.when(~found.startswith("+"), F.greatest(F.char_length(digits) - 10, F.lit(0))) \
            .when(digits.rlike(rf"\A{COUNTRY_1}"), 1).when(digits.rlike(rf"\A(?:{COUNTRY_2})"), 2).otherwise(3)
        return let(country, lambda n: F.concat(
            F.substr(digits, F.lit(1), n), _permuted_digits(F.substr(digits, n + 1), base)))

    def card(digits: Column, base: Column) -> Column:
        return let(F.concat(F.substring(digits, 1, 1), _permuted_digits(
            F.substr(digits, F.lit(2), F.char_length(digits) - 2), base)),
            lambda d: F.concat(d, ((10 - _luhn_sum(F.concat(d, F.lit("0"))) % 10) % 10).cast("string")))

    def domain(name: Column) -> Column:
        labels = F.split(F.regexp_replace(name, r"\.[^.]*\z", ""), r"\.")
        return F.array_join(F.transform(labels, lambda x: _turned_letters(
            x, F.concat_ws("|", F.lit(key), F.lit("domain"), name, x))), ".")

    def mail(attempt: Column, base: Column) -> Column:
        at = F.instr(found, "@")
        local = _turned_letters(F.concat(F.substr(found, F.lit(1), at - 1), F.repeat(F.lit("a"), attempt)),
                                F.concat_ws("|", base, F.lower(found)))
        return F.concat(local, F.lit("@"), let(F.lower(F.substr(found, at + 1)), domain), F.lit(".example"))

    def secret(value: Column, attempt: Column, base: Column) -> Column:
        return F.concat(F.substr(found, F.lit(1), F.char_length(found) - F.char_length(value)),
                        _turned_letters(F.concat(value, F.repeat(F.lit("a"), attempt - 3)), F.concat_ws("|", base, value)))

    def made(attempt: Column, base: Column, digits: Column) -> Column:
        return (F.when(kind == "phone", _written_into(found, phone(digits, base)))
                .when(kind == "card", _written_into(found, card(digits, base)))
                .when(kind == "social", _written_into(found, _permuted_digits(digits, base)))
                .when(kind == "address", _address(found, base))
                .when(kind == "mail", mail(attempt, base))
                .when(kind == "name", name_surrogate(found, key, lambda role, word: attempt))
                .when(kind == "account", _account(found, key, attempt))
                .when(kind == "secret", let(canonical(kind, found), lambda value: secret(value, attempt, base)))
                .otherwise(found))

    return let(attempt, lambda attempt: let(F.concat_ws("|", F.lit(key), kind, attempt), lambda base: let(
        F.regexp_replace(found, "[^0-9]", ""), lambda digits: made(attempt, base, digits))))


def collisions(entities: DataFrame, key: str) -> DataFrame:
    """Entities (kind, canonical, distinct; names by role, see ``entities_of``) that need another
    attempt than 0, with that attempt.

    A round looks at all entities with the attempts so far, until none collides.  Names, mail
    and secrets get longer with the attempts, so their space never gives out; the spaces of numbers and
    addresses are as large as their form."""
    name = F.col("kind").isin("family", "given")
    made = F.when(name, _stem(F.col("canonical"), F.col("kind"), key, F.col("attempt"))).otherwise(let(
        surrogate(F.col("kind"), F.col("canonical"), key, F.col("attempt")), lambda found: canonical(F.col("kind"), found)))
    own = F.when(name, _stem_of(F.col("canonical"), F.col("kind"))).otherwise(F.col("canonical"))
    named = entities.withColumn("attempt", F.lit(0))
    while True:
        now = checkpointed(named.withColumn("made", made))
        taken = now.groupBy("kind", "made").agg(F.count("*").alias("n"), F.min("canonical").alias("first"))
        real = now.select("kind", own.alias("made")).where("made IS NOT NULL").distinct().withColumn("real", F.lit(True))
        clash = (taken.join(real, ["kind", "made"], "left").where("n > 1 OR real")
                 .select("kind", "made", "first", F.coalesce("real", F.lit(False)).alias("real")))
        again = checkpointed(now.join(clash, ["kind", "made"])
                             .where(F.col("real") | (F.col("canonical") != F.col("first")))
                             .select("kind", "canonical", F.lit(1).alias("more")))
        if again.isEmpty():
            return now.where("attempt > 0").select("kind", "canonical", "attempt")
        named = (now.drop("made").join(again, ["kind", "canonical"], "left")
                 .select("kind", "canonical", (F.col("attempt") + F.coalesce("more", F.lit(0))).alias("attempt")))


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced, and ``entities``: kind, surrogate, and place in the new
    text (start from 0, in characters)."""
    seen = (docs.select(F.explode(mentions(F.col(quoted(text)))).alias("m")).where("m.kind IS NOT NULL")
            .select(F.explode(entities_of(F.col("m.kind"), F.col("m.canonical"))).alias("e")).select("e.*").distinct())
    odd = checkpointed(collisions(checkpointed(seen), key))
    row = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col(quoted(text)).cast("string").alias("text"))
    row = row.withColumn("found", mentions(F.col("text")))
    if odd.isEmpty():
        row = row.withColumn("attempts", F.lit(None).cast("map<string,int>"))
    else:
        # the exceptions of each text that has one, keyed by the text
        per_text = (row.where(F.size("found") > 0).select(F.sha2("text", 256).alias("id"), F.explode("found").alias("m"))
                    .where("m.kind IS NOT NULL")
                    .select("id", F.explode(entities_of(F.col("m.kind"), F.col("m.canonical"))).alias("e"))
                    .select("id", "e.*").distinct().join(odd, ["kind", "canonical"])
                    .groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct(
                        F.concat_ws("|", "kind", "canonical"), "attempt"))).alias("attempts")))
        row = (row.withColumn("id", F.when(F.size("found") > 0, F.sha2("text", 256)).otherwise(F.uuid()))
               .join(per_text, "id", "left").drop("id"))

    def made(m: Column, attempts: Column) -> Column:
        def attempt(kind: Column, canonical: Column) -> Column:
            return F.coalesce(F.try_element_at(attempts, F.concat_ws("|", kind, canonical)), F.lit(0))

        name = name_surrogate(m["found"], key, lambda role, word: attempt(role, F.lower(word)))
        return F.struct(m["kind"].alias("kind"), F.when(m["kind"].isNull(), m["found"]).when(m["kind"] == "name", name)
                        .otherwise(surrogate(m["kind"], m["found"], key, attempt(m["kind"], m["canonical"]))).alias("made"))

    def joined(text: Column, new: Column) -> Column:
        """New text, and the places of the surrogates."""
        places = "array<struct<kind:string,surrogate:string,start:int>>"

        def place(s: Column, x: Column) -> Column:
            begin = s["at"] + x["gap"]
            return F.struct(
                (begin + F.coalesce(F.char_length(x["m"]["made"]), F.lit(0))).alias("at"),
                F.when(x["m"]["kind"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(
                    x["m"]["kind"].alias("kind"), x["m"]["made"].alias("surrogate"), begin.alias("start"))))).alias("out"))

        def around(gaps: Column) -> Column:
            parts = F.zip_with(gaps, new, lambda g, m: F.concat(g, F.coalesce(m["made"], F.lit(""))))
            ends = F.transform(F.zip_with(gaps, new, lambda g, m: F.struct(g.alias("g"), m.alias("m"))),
                               lambda x: F.struct(F.char_length(x["g"]).alias("gap"), x["m"].alias("m")))
            zero = F.struct(F.lit(0).alias("at"), F.array().cast(places).alias("out"))
            return F.struct(F.array_join(parts, "").alias("text"),
                            F.aggregate(ends, zero, place, lambda s: s["out"]).alias("entities"))

        return let(F.split(text, pattern(text), F.lit(-1)), around)

    nothing = F.struct(F.col("text"), F.array().cast("array<struct<kind:string,surrogate:string,start:int>>").alias("entities"))
    new = F.when(F.exists("found", lambda m: m["kind"].isNotNull()), let(
        F.transform("found", lambda m: made(m, F.col("attempts"))), lambda n: joined(F.col("text"), n))).otherwise(nothing)
    row = row.withColumn("new", new)
    return row.select(*[F.col("new.text").alias(c) if c == text else F.col("row")[c].alias(c)
                        for c in others(docs, ["entities"])], F.col("new.entities").alias("entities"))
