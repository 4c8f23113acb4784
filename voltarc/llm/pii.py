"""PII surrogates with DataFrame functions only: keyed, type-consistent and distinct.

One pattern finds all entities of a text; each is replaced by a surrogate of its own type made from a keyed digest of its
canonical form, so that the same entity gets the same surrogate everywhere, however it is written:

* e-mail addresses: a local part of the same shape, a domain under a reserved name, the same one for the same domain;
* phone, card, account and social security numbers: the same separators and country code, and the digits counted from the
  right, so that a number with and without its country code agree; national numbers keep their first two digits, and 00 is read
  as +; check digits of cards and accounts stay valid;
* IP addresses: addresses, compressed IPv6 ones as their full form; secrets (quoted values of 8 characters, unquoted ones with
  a digit, keys of 32 hexadecimal digits, tokens with a public prefix, which stays): characters of the same classes, however
  long they are;
* persons, found by a title or by a known given name before a surname, in capitals too: known given names are exchanged within
  gender and script by a keyed cycle, unknown ones after a title are made with an ending of its gender, surnames are made from
  syllables of the same script, initials are redrawn, titles and particles stay, as do capitals. A name found so, given or
  family, is replaced wherever it stands alone in the same text, unless it is a common word.

Distinct entities keep distinct surrogates: candidates that two entities share, or that are themselves entities of the
corpus, are found by aggregates over all entities and redrawn in rounds until none is left; the redrawn ones reach the texts
by a join. After WIDEN redraws surrogates get longer by a digit each time, so a type whose entities fill their format ends too.
Digit runs that fail the check of a card number, and IP-like numbers over 255, are no entities.

The key is an argument or spark.voltarc.pii.key; without one, an application draws its own, and its surrogates can't be
linked with those of another run.

Defined cases: a null text stays null with 0 entities, an empty one stays empty; texts of any length are searched whole;
repeated rows get the same result; a null doc_id is no hindrance; of two entities with one candidate the older draw, then the
smaller entity, keeps it; an empty table gives an empty result; the other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import quoted, scope, settle, unsettle
from .spotsigs import ANCHORS

#: Redraws after which surrogates get longer, and after which something else must be wrong.
WIDEN = 8
MOST_ROUNDS = 100
#: Characters of an entity that are redrawn one by one; what is beyond them, by blocks.
SHAPED = 256
_OWN_KEYS: dict[str, str] = {}

#: Given names by script and gender; exchanged within their list (fixed values).
GIVEN = {
    "latin-f": "Anna Maria Emma Laura Julia Sophie Claire Camille Isabel Carmen Lucia Elena Mary Patricia Linda Susan Jennifer Karen Nancy Margaret Sandra Ursula Monika Petra Sabine Nathalie Valerie Pilar Rosa Teresa",
    "latin-m": "John James Robert Michael William David Richard Thomas Charles Peter Hans Klaus Jürgen Wolfgang Stefan Pierre Jean Michel Philippe François Carlos Miguel Antonio Javier Diego Pablo Luis Daniel George Edward",
    "cyrillic-f": "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия",
    "cyrillic-m": "Иван Александр Сергей Дмитрий Андрей Алексей Михаил Николай Владимир Пётр",
}
#: Titles that tell a gender, and others; those that count in capitals as well (fixed values).
TITLES_OF = {
    "f": "Mrs Ms Miss Frau Madame Mademoiselle Mme Mlle Señora Señorita Sra Srta Doña госпожа г-жа Госпожа".split(),
    "m": "Mr Herr Herrn Monsieur Señor Sr Don господин г-н Господин".split(),
    "": "Dr Prof".split(),
}
CAPITAL_TITLES = "MR MRS HERR FRAU MONSIEUR MADAME SEÑOR SEÑORA".split()
TITLES = [t for own in TITLES_OF.values() for t in own]
#: Endings of made given names.
ENDINGS = {"latin-f": "ina", "latin-m": "ino", "cyrillic-f": "ина", "cyrillic-m": "ан"}
#: Country calling codes of the numbering plan: one and two digits as listed, all others three (fixed value).
CALLING_CODE = r"^(?:\+|00(?=[1-9]\d))(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
SYLLABLES = {
    "latin": "bar ben bol cor dal den dor fen gar gol hal hen jor kel kor lan lem lin mar mel mon nor pel ran rin sol tam ter val wen".split(),
    "cyrillic": "бар бел вол гор дан дол жар зел кар кол лан лев мар мир нов пол рад сол тар тор".split(),
}

#: Words between a given name or title and a surname, the second kind only after one of the first (fixed values).
PARTICLES, AFTER_PARTICLE = "von van de del della di da du dos zu zur".split(), "der den dem la las los".split()

#: One capital inside a part of a name, as in McDonald, and one before its apostrophe, as in O'Brien.
_PART = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)?"
_NAME = f"{_PART}(?:[-'’]{_PART})*"
_UPPER_NAME = r"(?:\p{Lu}['’])?\p{Lu}{3,}(?:[-'’]\p{Lu}+)*"
_PARTICLE = f"(?:(?:{'|'.join(PARTICLES)}) (?:(?:{'|'.join(AFTER_PARTICLE)}) )?)?"
_ANY_NAME = f"{_PARTICLE}(?:{_NAME}|{_UPPER_NAME})"
INITIAL = r"\p{Lu}\."
LISTED = [n for names in GIVEN.values() for n in names.split()]
_TITLE = "(?:" + "|".join(TITLES) + ")"
_UPPER_TITLE = "(?:" + "|".join(CAPITAL_TITLES) + ")"
_ANY_TITLE = f"(?:{_TITLE}|{_UPPER_TITLE})"
_GIVEN = "(?:" + "|".join(LISTED) + ")"
_UPPER_GIVEN = "(?:" + "|".join(n.upper() for n in LISTED) + ")"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Letters of the scripts that part words by blanks: others would draw their neighbours into an address.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏΑ-ωЀ-ӿ"
EMAIL = rf"(?<![{_LETTER}0-9._%+-])[{_LETTER}0-9][{_LETTER}0-9._%+-]{{0,63}}@[{_LETTER}0-9-]{{1,63}}(?:\.[{_LETTER}0-9-]{{1,63}}){{0,8}}\.[{_LETTER}]{{2,24}}"
_KEY = r"(?:token|secret|passwd|password|api.?key)"
_VALUE = r"[^\s\"',;&<>(){}\[\]]"
#: Tokens known by their public prefix, which their surrogates keep.
TOKEN_PREFIX = r"(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|AIza)"
TOKEN = r"(?<![0-9A-Za-z_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35})(?![0-9A-Za-z])"
#: A value without quotes has a digit; what stands before it is its lead, as quotes are.
UNQUOTED = rf"[=:](?i:(?<={_KEY}\s{{0,2}}[=:]))[ \t]{{0,2}}(?![=:])(?=[^\s\"',;&<>(){{}}\[\]\d]*+\d){_VALUE}{{8,}}(?<![.!?:])"
#: The quote before a secret is part of the match, and tells it from other entities (LEAD).
SECRET = r"[\"'](?i:(?<=(?:token|secret|passwd|password|api.?key)[\"']?\s{0,2}[=:]\s{0,2}[\"'])[^\"'\s]{8,}+)|(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])" + f"|{UNQUOTED}|{TOKEN}"
_GROUP = "[0-9A-Fa-f]{1,4}"
#: Eight groups, or fewer around "::" with a digit somewhere; ::1 alone is no one's.
IPV6 = (
    rf"(?<![0-9A-Fa-f:.])(?:{_GROUP}:){{7}}{_GROUP}(?![0-9A-Fa-f:]|\.\d)"
    rf"|(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?!(?:[0-9A-Fa-f]*:){{8}}[0-9A-Fa-f])(?:{_GROUP}(?::{_GROUP}){{0,6}}::(?:{_GROUP}(?::{_GROUP}){{0,5}})?|::{_GROUP}(?::{_GROUP}){{1,5}})(?![0-9A-Za-z:]|\.\d)"
)
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?:\d{11,26}|[A-Z]{4}\d{10,20}|(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?)(?![0-9A-Za-z])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
#: Numbers of a national plan: mobile ones parted after four digits, and five pairs that aren't part of a longer list.
NATIONAL = r"(?<![\d+.,-])01[5-7]\d[ /-]\d{3,4}[ -]?\d{4,5}(?!\d|[.-]\d)|(?<![\d+.,-])(?<!\d )0[1-9](?:(?: \d{2}){4}|(?:\.\d{2}){4})(?!\d|[ .-]\d)"
#: Numbers with 00 for +: with a separator after the country code, or whole ones of a European code.
ABROAD = r"(?<![\d+.,-])00(?:[1-9]\d{1,2}[ -]\d{2,4}(?:[ -]?\d{2,4}){1,4}|(?:3[0-469]|4[013-9])\d{9,11})(?!\d|[.-]\d)"
PHONE = r"(?<![\d+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+[2-9]\d{0,2}[ -]?(?:\(\d{1,4}\)[ -]?)?\d{2,4}(?:[ -]?\d{2,4}){1,4}(?!\d|\.\d)|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]|\.\d)" + f"|{NATIONAL}|{ABROAD}"
CARD = r"(?<![\d-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|3[47]\d{2}(?: \d{6} \d{5}|-\d{6}-\d{5})|\d{13,19})(?![\d]|-\d)"
IPV4 = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
#: Every title and given name begins with a capital or with this letter: other words are passed at once.
PERSON = (
    rf"(?<![\p{{L}}\d])(?=[\p{{Lu}}г])(?:{_TITLE}\.? (?:(?:{_NAME}|{INITIAL}) ){{0,2}}{_ANY_NAME}|{_GIVEN} (?:{INITIAL} ){{0,2}}{_ANY_NAME}"
    rf"|(?=\p{{Lu}}{{2}})(?:{_UPPER_TITLE}\.? (?:{_UPPER_NAME} ){{0,2}}{_UPPER_NAME}|{_UPPER_GIVEN} {_UPPER_NAME}))(?![\p{{L}}\d])"
)
KINDS = (("email", EMAIL), ("secret", SECRET), ("ipv6", IPV6), ("iban", IBAN), ("ssn", SSN), ("phone", PHONE), ("ipv4", IPV4), ("person", PERSON))
#: CARD comes last: digits that fail its check must not hide another kind that begins with them. No kind has a group before it.
PATTERN = "|".join([*(p for _, p in KINDS), CARD])
#: What a match holds before its entity.
LEAD = r"^(?:[\"']|[=:][ \t]{0,2}(?![=:]))"


def bare(m: Column) -> Column:
    """A match without its lead."""
    return F.regexp_replace(m, LEAD, "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Sum of a digit string by the public check-digit rule of card numbers, the last digit counting once."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), term), F.lit(0), lambda a, x: a + x)  # at most 19 digits


def kind_of(m: Column) -> Column:
    """The type of a match; null if it is no entity. A failed check leaves a secret a secret."""
    return let(bare(m), lambda b: _kind(b, F.length(b) < F.length(m)))


def _kind(m: Column, led: Column) -> Column:
    card = m.rlike(f"^(?:{CARD})$") & ~m.rlike(f"^(?:{ABROAD})$")
    good = luhn_sum(_digits(m)) % 10 == 0
    out = F.when(card & (good | ~led), F.when(good, F.lit("card")))
    for kind, pattern in KINDS:  # secrets are known by what stands before them: the rest
        whole = {"person": r"^[\p{L}.’'-]+(?: [\p{L}.’'-]+)+$"}.get(kind, f"^(?:{pattern})$")
        out = out if kind == "secret" else out.when(m.rlike(whole), F.when(~m.rlike("^[0:]+$"), F.lit(kind)) if kind == "ipv6" else F.lit(kind))
    return out.otherwise(F.lit("secret"))


def canonical(kind: Column, m: Column) -> Column:
    """What an entity is known by, however it is written."""
    plain = F.lower(F.regexp_replace(m, r"[^0-9A-Za-z]", ""))
    phone = kind == "phone"
    one_plan = phone & ~F.startswith(m, F.lit("+"))  # ten digits are those of one plan
    abroad, national = phone & m.rlike(f"^(?:{ABROAD})$"), phone & m.rlike(f"^(?:{NATIONAL})$")
    return F.when(abroad, F.substr(plain, F.lit(3))).when(one_plan & ~national, F.concat(F.lit("1"), plain)).when(kind.isin("phone", "card", "ssn", "iban"), plain).when(kind == "email", F.lower(bare(m))).when(kind == "ipv6", full_ipv6(bare(m))).otherwise(bare(m))


def ipv6_sides(m: Column) -> tuple[Column, Column]:
    """The groups before and after "::"; all are before it if there is none."""
    sides = F.split(m, "::", -1)
    return tuple(F.filter(F.split(F.coalesce(F.get(sides, F.lit(k)), F.lit("")), ":"), lambda g: g != "") for k in (0, 1))


def full_ipv6(m: Column) -> Column:
    left, right = ipv6_sides(F.lower(m))
    groups = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right))), right)
    return F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ":")


def mod97(text: Column) -> Column:
    """Remainder by 97 of letters and digits read as numbers, letters as 10 to 35: the public check of account numbers."""
    def step(r: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(value < 10, (r * 10 + value) % 97).otherwise((r * 100 + value) % 97)

    return F.aggregate(F.split(F.upper(text), ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c)))


def is_title(w: Column) -> Column:
    return w.rlike(rf"^{_ANY_TITLE}\.?$")


def name_parts(m: Column) -> Column:
    """(w, role) of each word of a person's match: title, particle, initial, listed (given name), given-f, given-m (after a title) or surname."""
    words = F.split(m, " ")
    first = F.upper(F.regexp_replace(F.get(words, F.lit(0)), r"\.$", ""))
    gender = F.when(first.isin([t.upper() for t in TITLES_OF["f"]]), "f").when(first.isin([t.upper() for t in TITLES_OF["m"]]), "m")

    def part(w: Column, i: Column) -> Column:
        role = F.when(is_title(w), "title").when(w.isin(PARTICLES + AFTER_PARTICLE), "particle").when(w.rlike(f"^{INITIAL}$"), "initial").when(F.initcap(F.lower(w)).isin(LISTED), "listed").when((i < F.size(words) - 1) & gender.isNotNull(), F.concat(F.lit("given-"), gender)).otherwise("surname")
        return F.struct(w.alias("w"), role.alias("role"))

    return F.transform(words, part)


def made_parts(m: Column) -> Column:
    """The words of a person's match that get a made name."""
    return F.filter(name_parts(m), lambda p: ~p["role"].isin("title", "particle", "initial", "listed"))


def domain_of(m: Column) -> Column:
    return F.lower(F.substring_index(bare(m), "@", -1))


class Surrogates:
    """Builds the expressions for one key."""

    def __init__(self, key: str) -> None:
        self.key = key
        self.given = {}
        for names in GIVEN.values():  # one cycle in the order of a keyed digest: no name stays, none meets another
            order = sorted(names.split(), key=lambda n: hashlib.sha256(f"{key}|given|{n}".encode()).digest())
            self.given |= {a: b for a, b in zip(order, order[1:] + order[:1], strict=True)}
        self.given_map = F.create_map(*[F.lit(x) for pair in sorted(self.given.items()) for x in pair])

    def seed(self, kind: str | Column, of: Column, attempt: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.sha2(F.concat_ws("|", F.lit(self.key), kind, of, attempt.cast("string")).cast("binary"), 256)

    @staticmethod
    def number(seed: Column, i: Column, n: int | Column) -> Column:
        return F.pmod(F.xxhash64(seed, i), F.lit(n) if isinstance(n, int) else n).cast("int")

    def shaped(self, m: Column, seed: Column, keep: Column, hexadecimal: Column) -> Column:
        """``m`` with each letter and digit after the first ``keep`` characters redrawn within its class, counted from the right."""

        def pick(letters: str, at: Column) -> Column:
            return F.substr(F.lit(letters), self.number(seed, at, len(letters)) + 1, F.lit(1))

        def one(i: Column) -> Column:
            return let(F.substr(m, i, F.lit(1)), lambda c: F.when((i <= keep) | ~c.rlike("^[0-9A-Za-z]$"), c).otherwise(let(F.length(F.regexp_replace(F.substr(m, i, F.lit(SHAPED)), r"[^0-9A-Za-z]", "")), lambda at: redrawn_character(c, at))))

        def redrawn_character(c: Column, at: Column) -> Column:
            lower = F.when(hexadecimal, pick("abcdef0123456789", at)).otherwise(pick("abcdefghijklmnopqrstuvwxyz", at))
            digit = F.when(hexadecimal, pick("abcdef0123456789", at)).otherwise(pick("0123456789", at))
            upper_hex = m.rlike("[A-F]")
            return F.when(c.rlike("^[0-9]$"), F.when(hexadecimal & upper_hex, F.upper(digit)).otherwise(digit)).when(c.rlike("^[a-z]$"), lower).otherwise(F.upper(lower))

        def drawn_tail(left: Column) -> Column:
            """Blocks of a digest in place of what is beyond SHAPED characters."""
            blocks = F.transform(F.sequence(F.lit(1), F.ceil(left / 64).cast("int")), lambda j: F.sha2(F.concat_ws("|", seed, j.cast("string")).cast("binary"), 256))
            whole = F.substr(F.array_join(blocks, ""), F.lit(1), left)
            return F.when(~m.rlike("[A-Za-z]"), F.translate(whole, "abcdef", "012345")).when(~m.rlike("[a-z]"), F.upper(whole)).otherwise(whole)

        head = F.array_join(F.transform(F.sequence(F.lit(1), F.least(F.greatest(F.length(m), F.lit(1)), F.lit(SHAPED))), one), "")
        return F.when(F.length(m) <= SHAPED, head).otherwise(F.concat(head, drawn_tail(F.length(m) - SHAPED)))

    def made_name(self, w: Column, role: Column, attempt: Column) -> Column:
        """A surname of syllables in the word's script, or a given name with an ending besides; later attempts are longer."""

        def made(script: str, seed: Column) -> Column:
            parts = F.array(*[F.lit(s) for s in SYLLABLES[script]])
            ending = F.when(role == "given-f", ENDINGS[f"{script}-f"]).when(role == "given-m", ENDINGS[f"{script}-m"]).otherwise("")
            stem = F.array_join(F.transform(F.sequence(F.lit(1), attempt + F.when(role == "surname", 3).otherwise(2)), lambda i: F.get(parts, self.number(seed, i, len(SYLLABLES[script])))), "")
            return F.initcap(F.concat(stem, ending))

        name = let(self.seed(role, F.lower(w), attempt), lambda seed: F.when(w.rlike(r"\p{IsCyrillic}"), made("cyrillic", seed)).otherwise(made("latin", seed)))
        return F.when(w.rlike(r"^\P{Ll}{2,}$"), F.upper(name)).otherwise(name)

    def letter(self, w: Column, letters: str) -> Column:
        """Another letter for an initial."""
        others = F.replace(F.lit(letters), F.substr(w, F.lit(1), F.lit(1)), F.lit(""))
        return F.substr(others, self.number(self.seed("initial", w, F.lit(0)), F.lit(1), len(letters) - 1) + 1, F.lit(1))

    def word(self, w: Column, role: Column, attempt_of) -> Column:  # noqa: ANN001
        """A word of a person's name."""
        listed = F.element_at(self.given_map, F.initcap(F.lower(w)))
        made = let(attempt_of(role, F.lower(w)), lambda attempt: self.made_name(w, role, attempt))
        letter = F.when(w.rlike(r"^\p{IsCyrillic}"), self.letter(w, "АБВГДЕЖЗИКЛМНОПРСТ")).otherwise(self.letter(w, "ABCDEFGHIJKLMNOPRSTVW"))
        return F.when(role.isin("title", "particle"), w).when(role == "initial", F.concat(letter, F.lit("."))).when(role == "listed", F.when(w.rlike(r"^\P{Ll}{2,}$"), F.upper(listed)).otherwise(listed)).otherwise(made)

    def person(self, m: Column, attempt_of) -> Column:  # noqa: ANN001
        return F.array_join(F.transform(name_parts(m), lambda p: self.word(p["w"], p["role"], attempt_of)), " ")

    def card(self, m: Column, seed: Column) -> Column:
        """Redrawn digits, the last one such that the check holds."""
        head = self.shaped(F.substr(m, F.lit(1), F.length(m) - 1), seed, F.lit(0), F.lit(False))
        return let(head, lambda h: F.concat(h, F.pmod(10 - luhn_sum(F.concat(_digits(h), F.lit("0"))) % 10, F.lit(10)).cast("string")))

    def iban(self, m: Column, seed: Column) -> Column:
        """The same country, redrawn characters, and the two check digits that belong to them."""

        def checked(drawn: Column) -> Column:
            rest = F.substr(drawn, F.lit(5), F.length(drawn))
            account = F.concat(F.regexp_replace(rest, r"[^0-9A-Za-z]", ""), F.substr(drawn, F.lit(1), F.lit(2)), F.lit("00"))
            return F.concat(F.substr(drawn, F.lit(1), F.lit(2)), F.lpad((98 - mod97(account)).cast("string"), 2, "0"), rest)

        return let(self.shaped(m, seed, F.lit(4), F.lit(False)), checked)

    def ipv6(self, m: Column, seed: Column) -> Column:
        """Each group by its place in the full address, so that all ways to write it agree; zeros and the link-local prefix stay."""
        left, right = ipv6_sides(m)

        def drawn(g: Column, i: Column) -> Column:
            made = F.lpad(F.lower(F.hex(self.number(seed, i.cast("int"), 65535) + 1)), 4, "0")
            return F.when(g.rlike("^0+$") | (i == 0) & (F.lower(g) == "fe80"), g).when(m.rlike("[A-F]"), F.upper(made)).otherwise(made)

        first = F.array_join(F.transform(left, drawn), ":")
        return F.when(~F.contains(m, F.lit("::")), first).otherwise(F.concat(first, F.lit("::"), F.array_join(F.transform(right, lambda g, i: drawn(g, 8 - F.size(right) + i)), ":")))

    def host(self, domain: Column, attempt: Column) -> Column:
        def made(at: Column) -> Column:
            label = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8) + attempt), lambda i: F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), self.number(at, i, 26) + 1, F.lit(1))), "")
            return F.concat(label, F.lit(".example."), F.get(F.array(*map(F.lit, ("com", "net", "org"))), self.number(at, F.lit(9), 3)))

        return let(self.seed("domain", domain, attempt), made)

    def mailbox(self, m: Column, attempt: Column) -> Column:
        """The local part of an address, in plain letters."""
        local = F.regexp_replace(F.substring_index(m, "@", 1), r"[^\x00-\x7F]", "x")
        name = let(self.seed("email", F.lower(m), attempt), lambda seed: self.shaped(local, seed, F.lit(0), F.lit(False)))
        return F.concat(name, F.when(attempt > 0, attempt.cast("string")).otherwise(""))

    def email(self, m: Column, attempt: Column, host_attempt: Column) -> Column:
        made = F.concat(self.mailbox(m, attempt), F.lit("@"), self.host(domain_of(m), host_attempt))
        return F.when(m.rlike("^[^a-z]+$"), F.upper(made)).otherwise(made)

    def entity(self, kind: Column, m: Column, attempt_of) -> Column:  # noqa: ANN001
        """The surrogate of a match of a kind, after its lead; ``attempt_of(kind, canonical)`` is the number of redraws."""
        return F.concat(F.regexp_extract(m, LEAD, 0), let(bare(m), lambda b: self._entity(kind, b, attempt_of)))

    def _entity(self, kind: Column, m: Column, attempt_of) -> Column:  # noqa: ANN001
        token = F.length(F.regexp_extract(m, f"^{TOKEN_PREFIX}", 0))
        is_hex = m.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$") & m.rlike("[A-Fa-f]") & kind.eqNullSafe("secret")

        def drawn(known: Column, attempt: Column) -> Column:
            return let(self.seed(kind, known, attempt), lambda seed: by_seed(seed, F.greatest(attempt - WIDEN, F.lit(0))))

        def by_seed(seed: Column, wider: Column) -> Column:
            def octets(n: Column) -> Column:
                return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: (self.number(seed, i, 254) + 1).cast("string")), ".")

            longer = F.concat(m, F.repeat(F.lit("0"), wider))
            keep = F.when((kind == "phone") & m.rlike(f"^(?:{NATIONAL})$"), 2).when(kind == "phone", F.length(F.regexp_extract(m, CALLING_CODE, 0))).when(kind == "secret", token).otherwise(0)
            shape = let(is_hex, lambda h: let(keep, lambda k: self.shaped(longer, seed, k, h)))
            six = F.when(wider > 0, self.ipv6(full_ipv6(F.regexp_replace(m, "0", "1")), seed)).otherwise(self.ipv6(m, seed))
            return F.when(kind == "ipv4", octets(F.lit(4) + wider)).when(kind == "ipv6", six).when(kind == "card", self.card(longer, seed)).when(kind == "iban", self.iban(longer, seed)).otherwise(shape)

        def by_known(known: Column) -> Column:
            return let(attempt_of(kind, known), lambda attempt: F.when(kind == "email", let(attempt_of(F.lit("domain"), domain_of(m)), lambda host: self.email(m, attempt, host))).otherwise(drawn(known, attempt)))

        return F.when(kind.isNull(), m).when(kind == "person", self.person(m, attempt_of)).otherwise(let(canonical(kind, m), by_known))


def may_hold(text: Column) -> Column:
    """False only for texts without any entity: a cheap look for what every pattern needs."""
    names = F.array(*[F.lit(n) for n in [*(t for t in TITLES if "-" not in t), *LISTED, *CAPITAL_TITLES, *(n.upper() for n in LISTED)]])
    words = F.split(F.regexp_replace(text, r"[^\p{L}]+", " "), " ")  # a title or given name is a whole run of letters
    hyphenated = [F.contains(text, F.lit(t)) for t in TITLES if "-" in t]
    quoted = (F.contains(text, F.lit('"')) | F.contains(text, F.lit("'"))) & text.rlike("[=:]")
    found = text.rlike("[0-9@]") | quoted & text.rlike("(?i)token|secret|passw|api.?key") | F.arrays_overlap(words, names)
    for h in hyphenated:
        found = found | h
    return found | text.rlike(f"[a-f]{{32}}|[A-F]{{32}}|:[A-Fa-f]{{0,4}}:|{TOKEN_PREFIX}")  # keys, addresses and tokens without any digit


def find(text: Column) -> Column:
    return F.when(may_hold(text), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def known_parts(m: Column, kind: Column) -> Column:
    """(kind, known, shown) of what is compared for a match: made names of a person, the domain of an address, the entity."""

    def part(kind: Column, known: Column, shown: Column) -> Column:
        return F.struct(kind.alias("kind"), known.alias("known"), shown.alias("shown"))

    own = part(kind, canonical(kind, m), m)
    names = F.transform(made_parts(m), lambda p: part(p["role"], F.lower(p["w"]), p["w"]))
    return F.when(kind == "person", names).when(kind == "email", F.array(own, part(F.lit("domain"), domain_of(m), domain_of(m)))).otherwise(F.array(own))


def entities(docs: DataFrame) -> DataFrame:
    """Distinct (kind, known, shown) of all texts: what is compared, and one way it is written."""
    found = settle(docs.select(F.explode(F.array_distinct(find(F.col("text")))).alias("m")).distinct(), "matches")
    matches = found.withColumn("kind", kind_of(F.col("m"))).where("kind IS NOT NULL")
    return matches.select(F.explode(known_parts(F.col("m"), F.col("kind"))).alias("p")).select("p.*").groupBy("kind", "known").agg(F.min("shown").alias("shown"))


def redrawn(docs: DataFrame, make: Surrogates) -> DataFrame:
    """(kind, known, attempt) of the entities whose first surrogate isn't theirs alone; the list of all entities goes at once."""
    with scope() as kept:
        kept.append(settle(_redrawn(docs, make), "redrawn"))
    return kept[0]


def _redrawn(docs: DataFrame, make: Surrogates) -> DataFrame:

    def drawn(kind: Column, known: Column, shown: Column, attempt: Column) -> Column:
        """What must differ. Domains differ already, so addresses are compared by mailbox and their own domain."""
        name = kind.isin("surname", "given-f", "given-m")
        entity = let(make.entity(kind, shown, lambda *_: attempt), lambda made: canonical(kind, made))
        mailbox = F.concat(F.lower(make.mailbox(bare(shown), attempt)), F.lit("@"), domain_of(shown))
        return F.when(name, F.lower(make.made_name(shown, kind, attempt))).when(kind == "domain", make.host(known, attempt)).when(kind == "email", mailbox).otherwise(entity)

    everything = settle(entities(docs), "entities")
    real = everything.select("kind", F.col("known").alias("made"))
    state = settle(everything.withColumns({"attempt": F.lit(0), "since": F.lit(0), "made": drawn(F.col("kind"), F.col("known"), F.col("shown"), F.lit(0))}), "surrogates")
    for turn in range(1, MOST_ROUNDS + 1):
        first = state.groupBy("kind", "made").agg(F.count("*").alias("n"), F.min(F.struct("since", "known")).alias("owner")).where("n > 1").select("kind", "made", F.col("owner.known").alias("owner"))
        shared = state.join(first, ["kind", "made"]).where("known <> owner").select("kind", "known")
        taken = state.join(real, ["kind", "made"], "left_semi").select("kind", "known")
        again = settle(shared.unionByName(taken).distinct().withColumn("again", F.lit(True)), "again")
        if not again.limit(1).count():
            return state.where("attempt > 0").select("kind", "known", "attempt")
        moved = state.join(again, ["kind", "known"], "left").withColumns({"attempt": F.col("attempt") + F.coalesce(F.col("again").cast("int"), F.lit(0)), "since": F.when(F.col("again"), F.lit(turn)).otherwise(F.col("since"))})
        replaced = state
        state = settle(moved.withColumn("made", F.when(F.col("again"), drawn(F.col("kind"), F.col("known"), F.col("shown"), F.col("attempt"))).otherwise(F.col("made"))).drop("again"), "surrogates")
        unsettle(replaced)
        unsettle(again)
    raise RuntimeError("surrogates still collide though they have been made longer")


def key_of(spark: SparkSession, key: str | None = None) -> str:
    """The key that is given or set; else one that this application draws for itself."""
    return key or spark.conf.get("spark.voltarc.pii.key", None) or _OWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def with_surrogates(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``docs`` with the texts' entities replaced, and the number of replacements in n_entities."""
    names = [c for c in docs.columns if c != "n_entities"]
    return _replaced(docs, key).select(*[_kept(docs, c) for c in names], F.col("n").alias("n_entities"))


def _kept(docs: DataFrame, name: str) -> Column:
    return F.col("text") if name == "text" else F.col("row").getField(f"_{docs.columns.index(name)}").alias(name)


def _replaced(docs: DataFrame, key: str | None) -> DataFrame:
    """(row, text, n): the other columns as fields _0, _1 and so on, the text with surrogates, and their number."""
    make = Surrogates(key_of(docs.sparkSession, key))
    again = redrawn(docs, make)
    others = [F.col(quoted(c)).alias(f"_{k}") for k, c in enumerate(docs.columns) if c != "text"]
    own = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), "text", find(F.col("text")).alias("found"))
    if again.limit(1).count():  # the texts with such entities get a map of their redraws
        parts = F.flatten(F.transform("found", lambda m: let(kind_of(m), lambda kind: F.when(kind.isNotNull(), known_parts(m, kind)).otherwise(F.array()))))
        met = own.where(F.size("found") > 0).select(F.xxhash64("text").alias("mark"), F.explode(parts).alias("e")).select("mark", "e.kind", "e.known").distinct()
        maps = met.join(again, ["kind", "known"]).groupBy("mark").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "known"), F.col("attempt")))).alias("again"))
        own = own.withColumn("mark", F.xxhash64("text")).join(settle(maps, "redrawn"), "mark", "left").drop("mark")

        def attempt_of(kind: Column, known: Column) -> Column:
            return F.coalesce(F.element_at("again", F.concat_ws("|", kind, known)), F.lit(0))
    else:
        unsettle(again)

        def attempt_of(kind: Column, known: Column) -> Column:
            return F.lit(0)

    some = F.size("found") > 0
    own = own.withColumns({"between": F.when(some, F.split(F.col("text"), PATTERN, -1)), "parts": F.when(some, alone_parts(F.col("found")))})
    own = own.withColumn("names", F.sort_array(F.array_distinct(F.transform("parts", lambda p: p["w"])), asc=False))
    pattern = F.concat(F.lit(r"(?<![\p{L}\d])(?:"), F.array_join("names", "|"), F.lit(r")(?![\p{L}\d])"))
    swaps = F.map_from_arrays("names", F.transform("names", lambda w: let(F.get(F.filter("parts", lambda p: p["w"] == w), F.lit(0)), lambda p: make.word(w, p["role"], attempt_of))))
    own = own.withColumn("alone", F.when(F.size("names") > 0, F.struct(pattern.alias("pattern"), swaps.alias("swaps"))))

    def mentions(t: Column) -> Column:
        """A piece between entities with the names in it replaced."""
        rest = F.split(t, F.col("alone.pattern"), -1)
        hits = F.regexp_extract_all(t, F.col("alone.pattern"), F.lit(0))
        swapped = let(rest, lambda r: F.concat(F.get(r, F.lit(0)), F.array_join(F.transform(hits, lambda w, i: F.concat(F.element_at(F.col("alone.swaps"), w), F.get(r, i + 1))), "")))
        return F.when(F.rlike(t, F.col("alone.pattern")), swapped).otherwise(t)

    n_alone = F.when(F.col("alone").isNotNull(), F.size(F.regexp_extract_all(F.array_join("between", "\n"), F.col("alone.pattern"), F.lit(0)))).otherwise(0)
    own = own.withColumns({"n_alone": n_alone, "between": F.when(F.col("alone").isNotNull(), F.transform("between", mentions)).otherwise(F.col("between"))})
    pieces = F.transform(F.arrays_zip(F.transform("found", lambda m: let(kind_of(m), lambda kind: make.entity(kind, m, attempt_of))).alias("s"), F.slice(F.col("between"), 2, F.greatest(F.size("found"), F.lit(0))).alias("t")), lambda x: F.concat(x["s"], x["t"]))
    replaced = F.when(some, F.concat(F.get("between", F.lit(0)), F.array_join(pieces, ""))).otherwise(F.col("text"))
    counted = F.coalesce(F.size(F.filter("found", lambda m: kind_of(m).isNotNull())), F.lit(0))
    return own.select("row", replaced.alias("text"), (F.greatest(counted, F.lit(0)) + F.col("n_alone")).cast("long").alias("n"))


def alone_parts(found: Column) -> Column:
    """(w, role) of the given and made names of the persons among a text's matches that may stand alone in it."""
    parts = F.flatten(F.transform(F.filter(found, lambda m: m.rlike(rf"^(?:{PERSON})$")), name_parts))
    named = F.filter(parts, lambda p: ~p["role"].isin("title", "particle", "initial"))
    return F.filter(named, lambda p: ~F.lower(p["w"]).isin(sorted(set(ANCHORS))) & (F.length(p["w"]) > 2))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates, and how many there are; nulls, ties and repeats as the module states."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_surrogates(docs).select("doc_id", "text", "n_entities")


def mask_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, their entities replaced and n_chars counted anew.

    Null and empty texts stay; every other column comes out as it was, n_entities and names with dots included; repeated
    rows stay equal; an empty table stays empty.
    """
    made = _replaced(docs, None)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in docs.columns else None
    return made.select(*[n_chars if c == "n_chars" else _kept(docs, c) for c in docs.columns])
