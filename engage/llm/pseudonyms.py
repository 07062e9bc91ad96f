"""Format-preserving pseudonyms of personal data, by a keyed Feistel network, in DataFrame functions alone.

Found values are permuted within their format: digits become digits, letters letters of the same case, an address of
four octets another one, a date another date of the same 400-year cycle, a card number one with the same Luhn remainder.
The permutation depends on the key and the kind of value only, so equal values have equal pseudonyms in all documents,
and different values of one format have different ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.llm.common import free_name, small_reads

ROUNDS = 8
HALF = 12  # symbols of a half; 26 ** 12 fits into a bigint
STRETCH = 1000  # numbers of a run that are put together before they join the rest, as each step copies what it has so far

# Each kind's pattern; a value belongs to the first kind that matches at its place. Octets, months, days and, below, Luhn
# sums and calendar dates are validated. Groups that repeat without bound are possessive: Java's matcher takes a stack frame or more
# for each turn of any other, so that a run of a thousand numbers would end the executor by a stack overflow.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Labels up to the last one that two letters follow.
_LABELS = r"(?:(?:[A-Za-z0-9-]++\.(?![A-Za-z]{2}))*+[A-Za-z0-9-]++\.(?=[A-Za-z]{2}))++"
_EMAIL = rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@{_LABELS}[A-Za-z]{{2,24}}"
_SECRET = (
    r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9_])(?i:password|passwd|pwd|secret|token|api_?key)[ \t]?[=:][ \t]?[\"']?[A-Za-z0-9+/_-]{6,}"
    r"|(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])"
)
_ADDRESS = rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_DATE = (
    r"(?<![\d/.-])(?:[12]\d{3}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[./](?:0[1-9]|1[0-2])[./][12]\d{3})(?![\d/-]|\.\d)"
)
_PHONE = (
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})(?!\w)"
)
_SOCIAL = r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])"
# Or several numbers in a row, one of which may be a card's: 13 digits at least, up to the last number that ends here.
_CARD = r"(?<![\w-])\d(?:[ -]?\d){12}\d*+(?:-\d++)*+(?![\w-])(?: \d++(?:-\d++)*+(?![\w-]))*+"
_HEX_DIGITS = r"\A[0-9]{32,64}\z"  # a hexadecimal key that happens to have no letters
PATTERN = "|".join([_EMAIL, _SECRET, _ADDRESS, _DATE, _PHONE, _SOCIAL, _CARD])
# Texts without any of these cannot hold a value.
TRIGGER = r"[0-9@]|AKIA|ASIA|[a-f]{32}|(?i:password|passwd|pwd|secret|token|api)"
CYCLE = 146097  # days of 400 years = 189 * 773


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _noise(key: str, tweak: Column, round_: Column, value: Column) -> Column:
    """60 pseudo-random bits from key, tweak, round and the other half."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), tweak, round_.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, tweak: Column) -> Column:
    """``struct<l, r>``: the keyed permutation of pairs with ``0 <= l < left_size`` and ``0 <= r < right_size``.

    The halves are changed in turn by adding a keyed function of the other, each modulo its own size; every round can be
    undone, so the whole is one to one.
    """

    def round_(state: Column, i: Column) -> Column:
        l = F.pmod(state["l"] + F.pmod(_noise(key, tweak, i * 2, state["r"]), left_size), left_size)
        return _bind(l, lambda new: F.struct(
            new.alias("l"),
            F.pmod(state["r"] + F.pmod(_noise(key, tweak, i * 2 + 1, new), right_size), right_size).alias("r"),
        ))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, round_)


def _radix(symbol: Column) -> Column:
    return F.when(symbol.between("0", "9"), F.lit(10)).otherwise(F.lit(26)).cast("long")


def _base(symbol: Column) -> Column:
    return F.when(symbol.between("0", "9"), 48).when(symbol.between("A", "Z"), 65).otherwise(97)


def _size(symbols: Column) -> Column:
    return F.aggregate(symbols, F.lit(1).cast("long"), lambda n, s: n * _radix(s))


def _number(symbols: Column) -> Column:
    return F.aggregate(
        symbols, F.lit(0).cast("long"), lambda n, s: n * _radix(s) + (F.ascii(s) - _base(s)).cast("long")
    )


def _symbols(number: Column, like: Column) -> Column:
    """The text of a number in the digits and letters of the given symbols' classes."""

    def step(state: Column, s: Column) -> Column:
        return F.struct(
            F.call_function("div", state["n"], _radix(s)).alias("n"),
            F.concat(F.char((_base(s) + F.pmod(state["n"], _radix(s))).cast("long")), state["t"]).alias("t"),
        )

    start = F.struct(number.alias("n"), F.lit("").alias("t"))
    return F.aggregate(F.reverse(like), start, step, lambda state: state["t"])


def _permute_block(symbols: Column, key: str, tweak: Column) -> Column:
    half = F.floor((F.size(symbols) + 1) / 2).cast("int")
    halves = F.struct(
        F.slice(symbols, F.lit(1), half).alias("a"), F.slice(symbols, half + 1, F.lit(HALF)).alias("b")
    )
    return _bind(
        halves,
        lambda h: _bind(
            feistel(_number(h["a"]), _number(h["b"]), _size(h["a"]), _size(h["b"]), key, tweak),
            lambda out: F.concat(_symbols(out["l"], h["a"]), _symbols(out["r"], h["b"])),
        ),
    )


def permute_symbols(value: Column, key: str, kind: str) -> Column:
    """Permute the digits and ASCII letters of a value within their classes; all else stays in place.

    Blocks of 24 symbols are permuted on their own, each under its place and the classes of its symbols. The value is cut into
    pieces with a block each, so that no step walks over the whole of a long one again.
    """
    variable = "[0-9A-Za-z]"
    pieces = F.regexp_extract_all(value, F.lit(f"((?:[^0-9A-Za-z]*+{variable}){{1,{2 * HALF}}})"), F.lit(1))
    rest = F.regexp_extract(value, r"(?<![^0-9A-Za-z])[^0-9A-Za-z]*+\z", 0)
    form = lambda s: F.translate(
        F.array_join(s, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0" * 10 + "A" * 26 + "a" * 26
    )

    def put_back(piece: Column, text: Column) -> Column:
        between = F.split(piece, variable, -1)
        return F.array_join(F.transform(between, lambda gap, i: F.concat(gap, F.substring(text, i + 1, F.lit(1)))), "")

    def shuffled(piece: Column, k: Column) -> Column:
        return _bind(
            F.regexp_extract_all(piece, F.lit(f"({variable})"), F.lit(1)),
            lambda s: _bind(
                _permute_block(s, key, F.concat_ws(":", F.lit(kind), k.cast("string"), form(s))), lambda text: put_back(piece, text)
            ),
        )

    return F.concat(F.array_join(F.transform(pieces, shuffled), ""), rest)


def _email(value: Column, key: str) -> Column:
    """The local part and every label of the host but the last."""
    local, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.substring_index(host, ".", -1)
    labels = F.substring(host, F.lit(1), F.length(host) - F.length(top) - 1)
    return F.concat(
        permute_symbols(local, key, "local"), F.lit("@"), permute_symbols(labels, key, "host"), F.lit("."), top
    )


def _address(value: Column, key: str) -> Column:
    octet = lambda k: F.element_at(F.split(value, r"\."), k).cast("long")
    n = F.lit(65536).cast("long")
    out = feistel(octet(1) * 256 + octet(2), octet(3) * 256 + octet(4), n, n, key, F.lit("address"))
    byte = lambda half: F.concat_ws(".", F.floor(half / 256).cast("string"), F.pmod(half, F.lit(256)).cast("string"))
    return _bind(out, lambda o: F.concat_ws(".", byte(o["l"]), byte(o["r"])))


def _date(value: Column, key: str) -> Column:
    """Year-month-day, or day, month and year with points or slashes. An impossible date is permuted by its digits."""
    iso = F.substring(value, 5, 1) == "-"
    y = F.when(iso, F.substring(value, 1, 4)).otherwise(F.substring(value, 7, 4))
    m = F.when(iso, F.substring(value, 6, 2)).otherwise(F.substring(value, 4, 2))
    d = F.when(iso, F.substring(value, 9, 2)).otherwise(F.substring(value, 1, 2))
    day = F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")

    def moved(date: Column) -> Column:
        first = F.make_date(F.floor(F.year(date) / 400).cast("int") * 400 + 1, F.lit(1), F.lit(1))
        # Cycles that start with a year 400 k + 1 and end with the year 400 (k + 1); year 400 k counts with the one before.
        first = F.when(F.pmod(F.year(date), F.lit(400)) == 0, F.make_date(F.year(date) - 399, F.lit(1), F.lit(1))).otherwise(first)
        at = F.datediff(date, first)
        parts = feistel(F.floor(at / 773), F.pmod(at, F.lit(773)), F.lit(189).cast("long"), F.lit(773).cast("long"), key, F.lit("date"))
        return _bind(parts, lambda o: F.date_add(first, (o["l"] * 773 + o["r"]).cast("int")))

    def shown(date: Column) -> Column:
        return F.when(iso, F.date_format(date, "yyyy-MM-dd")).otherwise(
            F.concat(
                F.date_format(date, "dd"), F.substring(value, 3, 1), F.date_format(date, "MM"),
                F.substring(value, 6, 1), F.date_format(date, "yyyy"),
            )
        )

    return F.when(day.isNull(), permute_symbols(value, key, "number")).otherwise(_bind(moved(day), shown))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of an array of digits, the last of which is the check digit's place."""
    n = F.size(digits)
    worth = F.transform(
        digits,
        lambda s, i: _bind(
            s.cast("int") * F.when(F.pmod(n - 1 - i, F.lit(2)) == 1, 2).otherwise(1), lambda v: v - F.when(v > 9, 9).otherwise(0)
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda a, v: a + v)


def _digits(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("([0-9])"), F.lit(1))


def _valid(number: Column) -> Column:
    return F.length(number).between(13, 19) & (F.pmod(luhn_sum(_digits(number)), F.lit(10)) == 0)


def _joined(groups: Column, i: Column, k: Column) -> Column:
    return F.array_join(F.slice(groups, i, k), "")


def _card_groups(groups: Column, i: Column, usual: bool) -> Column:
    """How many groups from the i-th on are a card's number, 0 if none is: one group, or the usual groupings (4-4-4-4, 4-6-5, and
    4-4-4-4-3); else (``usual`` false) any groups, 16 and 15 digits before other lengths, longer ones first."""
    sizes = lambda k: F.array_join(F.transform(F.slice(groups, i, k), lambda g: F.length(g).cast("string")), "-")
    plain = lambda k: (k == 1) | sizes(k).isin("4-4-4-4", "4-6-5", "4-4-4-4-3")
    lengths = F.sequence(F.lit(1), F.least(F.lit(19), F.size(groups) - i + 1))
    fit = F.filter(lengths, lambda k: plain(k) & _bind(_joined(groups, i, k), _valid) if usual else _bind(_joined(groups, i, k), _valid))

    def place(k: Column) -> Column:
        n = F.length(_joined(groups, i, k))
        return F.struct(F.when(n == 16, 0).when(n == 15, 1).otherwise(32 - n).alias("p"), k.alias("k"))

    return F.coalesce(F.array_min(F.transform(fit, place))["k"], F.lit(0))


def _card_at(groups: Column, i: Column) -> Column:
    """Groups of the card that starts at the i-th; an unusual grouping gives way to a usual one that starts within it."""
    within = lambda k: F.exists(F.sequence(i + 1, i + k), lambda j: (j < i + k) & (_card_groups(groups, j, True) > 0))
    other = _bind(_card_groups(groups, i, False), lambda k: F.when((k > 1) & within(k), 0).otherwise(k))
    return _bind(_card_groups(groups, i, True), lambda k: F.when(k > 0, k).otherwise(other))


def holds_no_card(value: Column) -> Column:
    """Whether a found value is a run of numbers of which no 13 to 19 digits in whole groups have a Luhn sum that is valid."""
    any_valid = lambda groups: F.exists(F.sequence(F.lit(1), F.size(groups)), lambda i: _card_groups(groups, i, False) > 0)
    numbers = value.rlike(rf"\A(?:{_CARD})\z") & ~value.rlike(_HEX_DIGITS)
    return F.when(numbers, ~_bind(F.split(value, "[ -]"), any_valid)).otherwise(F.lit(False))


def _card(number: Column, key: str) -> Column:
    """All digits but the last are permuted; the last is set so that the Luhn sum stays valid."""
    body = F.substring(number, F.lit(1), F.length(number) - 1)
    check = lambda new: F.pmod(-luhn_sum(F.concat(_digits(new), F.array(F.lit("0")))), F.lit(10)).cast("string")
    return _bind(permute_symbols(body, key, "card"), lambda new: F.concat(new, check(new)))


def _cards(value: Column, key: str) -> Column:
    """A run of numbers with each card in it replaced, digit for digit; other numbers and what parts the groups stay."""

    def read(run: Column) -> Column:
        groups, gaps = run["groups"], run["gaps"]

        def step(state: Column, i: Column) -> Column:
            group = F.element_at(groups, i)
            gap = F.when(i > 1, F.get(gaps, i - 2)).otherwise("")
            card = lambda k: F.when(k > 0, _card(_joined(groups, i, F.greatest(k, F.lit(1))), key)).otherwise("")
            found = F.when(state["left"] != "", state["left"]).otherwise(_bind(_card_at(groups, i), card))
            return _bind(
                found,
                lambda new: F.struct(
                    F.concat(state["out"], gap, F.when(new != "", F.substring(new, F.lit(1), F.length(group))).otherwise(group)).alias("out"),
                    F.substring(new, F.length(group) + 1, F.lit(19)).alias("left"),
                ),
            )

        def stretch(state: Column, first: Column) -> Column:
            last = F.least(first + (STRETCH - 1), F.size(groups))
            start = F.struct(F.lit("").alias("out"), state["left"].alias("left"))
            return _bind(
                F.aggregate(F.sequence(first, last), start, step),
                lambda new: F.struct(F.concat(state["out"], new["out"]).alias("out"), new["left"].alias("left")),
            )

        start = F.struct(F.lit("").alias("out"), F.lit("").alias("left"))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups), F.lit(STRETCH)), start, stretch, lambda state: state["out"])

    run = F.struct(F.split(value, "[ -]").alias("groups"), F.regexp_extract_all(value, F.lit("([ -])"), F.lit(1)).alias("gaps"))
    return _bind(run, read)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value, by its kind."""
    whole = lambda pattern: value.rlike(rf"\A(?:{pattern})\z")
    name = F.regexp_extract(value, r"\A(?:AKIA|ASIA|[A-Za-z_]+[ \t]?[=:][ \t]?[\"']?)", 0)
    secret = F.concat(name, permute_symbols(F.substring(value, F.length(name) + 1, F.length(value)), key, "secret"))
    country = F.regexp_extract(value, r"\A\+\d{1,3}(?=[ .(-])", 0)
    phone = F.concat(country, permute_symbols(F.substring(value, F.length(country) + 1, F.length(value)), key, "phone"))
    return (
        F.when(F.contains(value, F.lit("@")) & whole(_EMAIL), _email(value, key))
        .when(value.rlike("[A-Za-z]"), secret)
        .when(whole(_ADDRESS), _address(value, key))
        .when(whole(_DATE), _date(value, key))
        .when(whole(_PHONE), phone)
        .when(whole(_SOCIAL), permute_symbols(value, key, "social"))
        .when(whole(_CARD) & ~value.rlike(_HEX_DIGITS), _cards(value, key))
        .otherwise(permute_symbols(value, key, "number"))
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and the number of replaced values in ``n_replaced`` (bigint).

    Values are e-mail and network addresses, telephone, card and social security numbers, calendar dates, and secrets
    (access keys, passwords, long hexadecimal keys). Whole texts are searched, however long. A null text stays null and counts
    0, an empty one stays empty; numbers of 13 or more digits stay, but for those 13 to 19 of them, in whole groups, that pass the Luhn
    check: these alone are replaced, and alike wherever they stand; repeated rows get equal results; other columns and null ids pass through. A column
    ``n_replaced`` of ``docs`` is replaced. No shuffle: one pass of map-side functions; the Feistel rounds run for found
    values only. Texts and runs of numbers may be long: they are searched without recursion and read a few at a time.
    """
    small_reads(docs.sparkSession)
    text = F.col("text")
    found = F.when(text.rlike(TRIGGER), F.regexp_extract_all(text, F.lit(f"({PATTERN})"), F.lit(1)))
    own = free_name(docs, "_found")
    marked = docs.withColumn(own, found)

    def woven() -> Column:
        new = F.transform(F.col(own), lambda v: F.when(holds_no_card(v), v).otherwise(pseudonym(v, key)))
        return F.array_join(
            F.zip_with(F.split(text, PATTERN, -1), new, lambda piece, v: F.concat(piece, F.coalesce(v, F.lit("")))), ""
        )

    n = F.coalesce(F.greatest(F.size(F.filter(own, lambda v: ~holds_no_card(v))), F.lit(0)), F.lit(0)).cast("long")
    return marked.withColumns({"text": F.when(F.size(own) > 0, woven()).otherwise(text), "n_replaced": n}).drop(own)
