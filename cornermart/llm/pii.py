"""Format-preserving pseudonyms for personal data, as Spark column expressions only.

Found values are checked (Luhn digit, mod-97, calendar, octet range) and then permuted by a keyed
Feistel network inside their own format, so a value keeps its look, equal values get equal
pseudonyms in every document, and the holder of the key can invert them. There is no join and no
shuffle: a pseudonym depends on the value and the key alone.

| kind | what is permuted |
|---|---|
| card number | all but the first digit; the Luhn digit is computed anew |
| phone (7 to 15 digits) | all digits, but for the first one after a plus sign |
| social security number | its rank among the valid ones |
| IBAN | the account part, letters to letters; check digits are computed anew |
| IPv4 | the 32-bit address |
| IPv6 | hexadecimal digits, in place; two notations of one address aren't linked |
| date | the day within its century (Gregorian, years 1000 to 9999) |
| e-mail | letters and digits of the local part and of the domain, but for its last label |
| access key, password, token | letters and digits, hexadecimal ones within hexadecimal |

Dates with the month's name are prose and stay; four numbers after "v", "version" and the like are no
address. Without a key, given or set, the operator refuses to run but on a local master.

Defined cases: null stays null, an empty text stays empty, a text without valid values is returned
unchanged, a very long text is searched whole; where two kinds fit at one place, the first of the
order in ``ANY`` counts; repeated rows get equal results; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import let, unused

KEY_SETTING = "spark.cornermart.pii.key"
DEFAULT_KEY = "set spark.cornermart.pii.key to a secret"
ROUNDS = 8

DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"
NAMED = r"(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)[ ]?[=:][ ]?[\"']?)[A-Za-z0-9+/_-]{8,}"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.vV])(?<!\b(?i:version|release|revision|firmware|build)[ :]{1,2})[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
IPV6 = (
    r"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"
)
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4})(?![0-9]|[./-][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
    r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    r"|(?<![0-9][ .,])[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4}(?![ .,]?[0-9])|0[1-9][0-9]{1,3}[ /-][0-9]{6,8})(?![0-9])"
)
HINT = "[0-9@=:]|AKIA"  # every pattern needs one of these, and most texts have none
ANY = "|".join((EMAIL, NAMED, ACCESS_KEY, IBAN, IPV6, IPV4, DATE, SSN, CARD, PHONE))


def chars(text: Column) -> Column:
    return F.array_remove(F.split(text, ""), "")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _digest(key: str, kind: str, i: Column, size: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i, size, other).cast("binary"), 256)


def permute_text(text: Column, key: str, kind: str, alphabets: tuple[str, ...]) -> Column:
    """Permutes the characters of each alphabet among themselves; others stay in place.

    A Feistel network over the two halves: each round shifts the characters of one half
    by amounts that a keyed digest of the other half gives, so it can be undone.
    """

    def shifted(half: Column, digest: Column) -> Column:
        def one(ch: Column, k: Column) -> Column:
            amount = F.conv(F.substring(digest, (k % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            out = ch
            for alphabet in alphabets:
                place = F.instr(F.lit(alphabet), ch)
                turned = F.substring(F.lit(alphabet), (place - 1 + amount) % len(alphabet) + 1, F.lit(1))
                out = F.when(place > 0, turned).otherwise(out)
            return out

        return F.array_join(F.transform(chars(half), one), "")

    def step(s: Column, i: Column) -> Column:
        size = F.length(s["a"]) + F.length(s["b"])
        first = let(_digest(key, kind, i, size, s["b"]), lambda d: shifted(s["a"], d))
        second = let(_digest(key, kind, i, size, s["a"]), lambda d: shifted(s["b"], d))
        return F.when(i % 2 == 0, F.struct(first.alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), second.alias("b"))
        )

    middle = F.floor(F.length(text) / 2).cast("int")
    halves = F.struct(
        F.substring(text, F.lit(1), middle).alias("a"),
        F.substring(text, middle + 1, F.length(text)).alias("b"),
    )
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, halves, step, lambda s: F.concat(s["a"], s["b"]))


def permute_number(value: Column, key: str, kind: str, high: Column, low: Column) -> Column:
    """Permutes 0 to high * low - 1: a Feistel network over quotient and remainder by ``low``."""
    high, low = high.cast("bigint"), low.cast("bigint")

    def amount(i: Column, other: Column) -> Column:
        digest = _digest(key, kind, i, high * low, other)
        return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")

    def step(s: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 0, F.struct(F.pmod(s["a"] + amount(i, s["b"]), high).alias("a"), s["b"].alias("b"))
        ).otherwise(F.struct(s["a"].alias("a"), F.pmod(s["b"] + amount(i, s["a"]), low).alias("b")))

    start = F.struct(
        F.floor(value / low).cast("bigint").alias("a"), F.pmod(value, low).cast("bigint").alias("b")
    )
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, step, lambda s: s["a"] * low + s["b"])


def luhn_sum(digits: Column) -> Column:
    def worth(ch: Column, k: Column) -> Column:
        doubled = ch.cast("int") * 2
        return F.when(k % 2 == 0, ch.cast("int")).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.transform(chars(F.reverse(digits)), worth), F.lit(0), lambda a, x: a + x)


def mod97(text: Column) -> Column:
    """Remainder of the number that letters A to Z (as 10 to 35) and digits spell."""

    def step(a: Column, ch: Column) -> Column:
        letter = F.instr(F.lit(UPPER), ch)
        return F.when(letter > 0, (a * 100 + letter + 9) % 97).otherwise((a * 10 + F.instr(F.lit(DIGITS), ch) - 1) % 97)

    return F.aggregate(chars(text), F.lit(0), step)


def refill(shape: Column, filling: Column, kind: str) -> Column:
    """``shape`` with its characters of the class ``kind`` replaced in turn by those of ``filling``."""

    def one(ch: Column, k: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(shape, F.lit(1), k), f"[^{kind}]", ""))
        return F.when(ch.rlike(f"[{kind}]"), F.substring(filling, before + 1, F.lit(1))).otherwise(ch)

    return F.array_join(F.transform(chars(shape), one), "")


def _card(m: Column, key: str) -> Column:
    def valid(d: Column) -> Column:
        body = F.concat(
            F.substring(d, 1, 1),
            permute_text(F.substring(d, F.lit(2), F.length(d) - 2), key, "card", (DIGITS,)),
        )
        return let(
            body,
            lambda b: F.concat(b, F.pmod(F.lit(10) - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")),
        )

    return let(
        digits_of(m),
        lambda d: F.when(luhn_sum(d) % 10 == 0, let(valid(d), lambda new: refill(m, new, "0-9"))).otherwise(m),
    )


def _phone(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        kept = F.when(m.startswith("+"), F.lit(1)).otherwise(F.lit(0))
        rest = F.substring(d, kept + 1, F.length(d))
        return F.concat(F.substring(d, F.lit(1), kept), permute_text(rest, key, "phone", (DIGITS,)))

    return let(
        digits_of(m),
        lambda d: F.when(F.length(d).between(7, 15), let(new(d), lambda n: refill(m, n, "0-9"))).otherwise(m),
    )


def _ssn(m: Column, key: str) -> Column:
    def number(at: int, size: int) -> Column:
        return F.substring(m, at, size).cast("int")

    area, group, serial = number(1, 3), number(5, 2), number(8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = area - F.when(area > 666, F.lit(2)).otherwise(F.lit(1))  # 898 areas: 001 to 899 without 666
    value = ((rank * 99 + group - 1).cast("bigint")) * 9999 + serial - 1

    def written(v: Column) -> Column:
        top = F.floor(v / 9999)
        r = F.floor(top / 99)
        return F.format_string(
            "%03d-%02d-%04d",
            (r + F.when(r >= 665, F.lit(2)).otherwise(F.lit(1))).cast("int"),
            (top % 99 + 1).cast("int"),
            (v % 9999 + 1).cast("int"),
        )

    new = let(permute_number(value, key, "ssn", F.lit(898 * 99), F.lit(9999)), written)
    return F.when(valid, new).otherwise(m)


def _iban(m: Column, key: str) -> Column:
    def new(s: Column) -> Column:
        country = F.substring(s, 1, 2)
        account = permute_text(F.substring(s, F.lit(5), F.length(s)), key, "iban", (DIGITS, UPPER))
        return let(
            account,
            lambda a: F.concat(
                country, F.format_string("%02d", (98 - mod97(F.concat(a, country, F.lit("00")))).cast("int")), a
            ),
        )

    compact = F.regexp_replace(m, " ", "")
    return let(
        compact,
        lambda s: F.when(
            mod97(F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))) == 1,
            let(new(s), lambda n: refill(m, n, "A-Z0-9")),
        ).otherwise(m),
    )


def _ipv4(m: Column, key: str) -> Column:
    def new(parts: Column) -> Column:
        ok = F.forall(parts, lambda p: (p.cast("int") < 256) & ~p.rlike("^0[0-9]"))
        value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 256 + p.cast("bigint"))
        written = let(
            permute_number(value, key, "ipv4", F.lit(65536), F.lit(65536)),
            lambda v: F.concat_ws(".", *[F.pmod(F.floor(v / 256**k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)]),
        )
        return F.when(ok, written).otherwise(m)

    return let(F.split(m, r"\."), new)


def _ipv6(m: Column, key: str) -> Column:
    """Hexadecimal digits stay such in their places, so the notation is kept."""
    groups = F.size(F.filter(F.split(m, ":"), lambda g: g != ""))
    new = F.when(m.rlike("[A-F]"), permute_text(m, key, "ipv6", (DIGITS + UPPER[:6], LOWER[:6]))).otherwise(
        permute_text(m, key, "ipv6", (HEX,))
    )
    return F.when(groups < F.when(m.contains("::"), F.lit(8)).otherwise(F.lit(9)), new).otherwise(m)


def _date(m: Column, key: str) -> Column:
    """Year first, or with dots and hyphens day first; slashes: month first where that is a date, else day first."""
    early = m.rlike("^[0-9]{4}")
    parts = F.split(m, "[./-]")

    def iso_of(year: int, month: int, day: int) -> Column:
        padded = [F.lpad(F.get(parts, F.lit(k)), 2, "0") for k in (month, day)]
        return F.concat_ws("-", F.get(parts, F.lit(year)), *padded).try_cast("date")

    day_first = iso_of(2, 1, 0)
    american = ~early & m.contains("/") & iso_of(2, 0, 1).isNotNull()
    day = F.when(early, iso_of(0, 1, 2)).otherwise(F.when(american, iso_of(2, 0, 1)).otherwise(day_first))

    def new(d: Column) -> Column:
        century = F.floor(F.year(d) / 100).cast("int")
        first = F.make_date(century * 100, F.lit(1), F.lit(1))
        leap = century % 4 == 0  # such a century has 36,525 days, others 36,524
        high = F.when(leap, F.lit(75)).otherwise(F.lit(92))
        low = F.when(leap, F.lit(487)).otherwise(F.lit(397))
        moved = F.date_add(first, permute_number(F.date_diff(d, first).cast("bigint"), key, "date", high, low).cast("int"))
        fields = lambda pattern: F.date_format(moved, pattern)
        return (
            F.when(early & m.contains("/"), fields("yyyy/MM/dd"))
            .when(early, fields("yyyy-MM-dd"))
            .when(american, fields("MM/dd/yyyy"))
            .when(m.contains("/"), fields("dd/MM/yyyy"))
            .when(m.contains("-"), fields("dd-MM-yyyy"))
            .otherwise(fields("dd.MM.yyyy"))
        )

    return let(day, lambda d: F.when(d.isNull() | (F.year(d) < 1000), m).otherwise(new(d)))


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    local = F.substring(m, F.lit(1), at - 1)
    domain = F.substring(m, at + 1, F.length(m))
    last = F.regexp_extract(domain, r"\.[A-Za-z]+$", 0)
    site = F.substring(domain, F.lit(1), F.length(domain) - F.length(last))
    kinds = (DIGITS, LOWER, UPPER)
    return F.concat(permute_text(local, key, "local", kinds), F.lit("@"), permute_text(site, key, "domain", kinds), last)


def _secret(m: Column, key: str) -> Column:
    """Keeps the name before the value, or the four letters an access key starts with."""
    named = m.rlike(f"^{NAMED}$")
    head = F.when(named, F.regexp_extract(m, r"^[A-Za-z_-]+[ ]?[=:][ ]?[\"']?", 0)).otherwise(F.lit("AKIA"))

    def new(value: Column) -> Column:
        return F.when(value.rlike("^[0-9a-f]+$"), permute_text(value, key, "hex", (HEX,))).otherwise(
            permute_text(value, key, "secret", (DIGITS, LOWER, UPPER))
        )

    return let(head, lambda h: F.concat(h, let(F.substring(m, F.length(h) + 1, F.length(m)), new)))


def pseudonym(m: Column, key: str) -> Column:
    """Pseudonym of one found value; the value itself where its check fails."""
    whole = lambda pattern: m.rlike(f"^(?:{pattern.replace(chr(92) + '2', chr(92) + '1')})$")
    return (
        F.when(whole(NAMED) | whole(ACCESS_KEY), _secret(m, key))
        .when(whole(EMAIL), _email(m, key))
        .when(whole(IBAN), _iban(m, key))
        .when(whole(IPV6), _ipv6(m, key))
        .when(whole(IPV4), _ipv4(m, key))
        .when(whole(DATE), _date(m, key))
        .when(whole(SSN), _ssn(m, key))
        .when(whole(CARD), _card(m, key))
        .otherwise(_phone(m, key))
    )


def pseudonymised(text: Column, key: str) -> Column:
    """Struct: text with pseudonyms, and the number of values replaced (bigint)."""

    def joined(found: Column, gaps: Column) -> Column:
        new = F.transform(found, lambda m: pseudonym(m, key))
        return let(
            new,
            lambda n: F.struct(
                F.array_join(F.transform(gaps, lambda g, k: F.concat(g, F.coalesce(F.get(n, k), F.lit("")))), "").alias("text"),
                F.size(F.filter(F.zip_with(found, n, lambda a, b: a != b), lambda x: x)).cast("bigint").alias("n_replaced"),
            ),
        )

    changed = let(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda found: let(F.split(text, ANY, -1), lambda gaps: joined(found, gaps))
    )
    same = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n_replaced"))
    return F.when(F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False)), changed).otherwise(same)


def trial_key(spark: SparkSession) -> str:
    """The session's key, else the published one: for the named queries on test tables only."""
    return spark.conf.get(KEY_SETTING, DEFAULT_KEY)


def key_of(df: DataFrame, key: str | None = None) -> str:
    """The key given, or that of the session; on a local master a known one, elsewhere an error."""
    spark = df.sparkSession
    key = key or spark.conf.get(KEY_SETTING, None)
    if key:
        return key
    if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", spark.sparkContext.master):
        raise ValueError(f"pseudonyms need a secret key: set {KEY_SETTING}, or give one")
    return DEFAULT_KEY


def report(docs: DataFrame, key: str | None = None) -> DataFrame:
    """Id, pseudonymised text and number of replaced values of every document."""
    return docs.select("doc_id", pseudonymised(F.col("text"), key_of(docs, key)).alias("p")).select("doc_id", "p.*")


def replace(docs: DataFrame, key: str | None = None) -> DataFrame:
    """All columns, the text pseudonymised; ``n_chars`` follows the text where it changed."""
    own = unused(docs, "_pseudonymised")
    p = docs.select(*[F.col(f"`{c}`") for c in docs.columns], pseudonymised(F.col("text"), key_of(docs, key)).alias(own))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col(f"{own}.text").alias("text"))
        elif name == "n_chars":
            new = F.length(f"{own}.text").cast(docs.schema[name].dataType)
            columns.append(F.when(F.col(f"{own}.n_replaced") > 0, new).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return p.select(*columns)
