"""Pseudonyms of personal values by format-preserving Feistel networks, in SQL expressions only.

Candidates are found by one pattern, validated (Luhn and mod-97 check digits, calendar,
number ranges), and permuted within their format under a key: a value's two halves are
changed in turn by a keyed hash of the other half, modulo the sizes of the halves, so the
map is a permutation of the format.  Equal values get equal pseudonyms in all documents,
different ones different pseudonyms of the same format, and nobody without the key can
turn them back.

Numbers with fixed ranges (telephone numbers, addresses, dates) are pairs of whole numbers
modulo two sizes; character strings (cards, accounts, mail names, secrets) are shifted
character by character within digits, small or capital letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, ready

ROUNDS = 8

_MAIL = r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9.-]{1,190}\.[A-Za-z]{2,24}"
_SECRET_HEAD = r"""(?i:password|passwd|token|secret|api[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?"""
_SECRET = _SECRET_HEAD + r"[A-Za-z0-9+/_-]{8,}+"
_ACCESS_KEY = r"AKIA[A-Z0-9]{16}"
_IBAN = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"
#: Lengths of IBANs by country, for the printed form in groups of four.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}
_PRINTED_IBAN = "(?:" + "|".join(
    f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, names in _IBAN_LENGTHS.items()
) + ")"
_ADDRESS = r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
_YMD = r"(?:1[89]|2[01])[0-9]{2}([-/.])[01][0-9]\1[0-3][0-9]"
_DMY = r"[0-3]?[0-9]([-/.])[0-3]?[0-9]\2(?:1[89]|2[01])[0-9]{2}"
_SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_NATIONAL = r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
_ABROAD = r"\+[1-9][0-9](?:[ .()-]{0,2}[0-9]){6,13}"
#: Where a card may be: digits in groups, and a letter that spoils the last group.
_RUN = r"(?<![A-Za-z0-9])[0-9][0-9 -]{12,}+[A-Za-z]?"
#: At each border of groups in a run, the longest string of whole groups with 13 to 19 digits.
_CARDS_AT = r"(?<![A-Za-z0-9])(?=([0-9](?:[ -]?[0-9]){12,18})(?![A-Za-z0-9]))"
#: The string of whole groups with so many digits at the start of a longer one.
_CARD_OF = r"^[0-9](?:[ -]?[0-9]){%d}(?![0-9])"

_END = "(?![A-Za-z0-9])"
#: A date may be followed by a time.
_DATE_END = "(?:(?=[Tt][0-2][0-9])|(?![A-Za-z0-9]))"

#: Nothing but a value that stands by itself; cards are looked for in what is left.
PATTERN = "(?<![A-Za-z0-9])(?:" + "|".join(
    [x + _END for x in (_MAIL, _SECRET, _ACCESS_KEY, _PRINTED_IBAN, _IBAN, _ADDRESS)]
    + [x + _DATE_END for x in (_YMD, _DMY)] + [x + _END for x in (_SOCIAL, _NATIONAL, _ABROAD)]
) + ")"

# dates of 400 years, a whole cycle of the calendar: 189 * 773 days
_FIRST_DAY, _DAY_A, _DAY_B = "DATE'1800-01-01'", 189, 773


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _hash(key: str, tag: str, *parts: str) -> str:
    return f"sha2(concat_ws('|', {_quoted(key)}, '{tag}', {', '.join(parts)}), 256)"


def _number(hexed: str) -> str:
    return f"CAST(conv({hexed}, 16, 10) AS BIGINT)"


def _pair(key: str, tag: str, a: str, b: str, size_a: int, size_b: int) -> str:
    """A permutation of pairs below (size_a, size_b): struct with a and b."""
    rest = lambda other: _number(f"substr({_hash(key, tag, 'CAST(r AS STRING)', f'CAST({other} AS STRING)')}, 1, 15)")
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', CAST({a} AS BIGINT), 'b', CAST({b} AS BIGINT)), "
        f"(s, r) -> IF(r % 2 = 0, "
        f"named_struct('a', pmod(s.a + {rest('s.b')}, {size_a}L), 'b', s.b), "
        f"named_struct('a', s.a, 'b', pmod(s.b + {rest('s.a')}, {size_b}L))))"
    )


def _shifted(key: str, tag: str, x: str, round_: str, other: str) -> str:
    """Each character of ``x`` moved within its class by a keyed hash of ``other``."""
    step = _number(
        f"substr({_hash(key, tag, f'CAST({round_} AS STRING)', 'CAST((i - 1) DIV 8 AS STRING)', other)}, ((i - 1) % 8) * 8 + 1, 8)"
    )
    c = f"substr({x}, i, 1)"
    moved = lambda first, n: f"char({first} + pmod(ascii({c}) - {first} + {step}, {n}))"
    return (
        f"array_join(transform(sequence(1, length({x})), i -> CASE WHEN {c} BETWEEN '0' AND '9' THEN {moved(48, 10)} "
        f"WHEN {c} BETWEEN 'a' AND 'z' THEN {moved(97, 26)} WHEN {c} BETWEEN 'A' AND 'Z' THEN {moved(65, 26)} "
        f"ELSE {c} END), '')"
    )


def _characters(key: str, tag: str, x: str) -> str:
    """A permutation of the strings with the classes of ``x``, character by character."""
    pair = (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', substr(w, 1, length(w) DIV 2), 'b', "
        f"substr(w, length(w) DIV 2 + 1)), (s, r) -> IF(r % 2 = 0, "
        f"named_struct('a', {_shifted(key, tag, 's.a', 'r', 's.b')}, 'b', s.b), "
        f"named_struct('a', s.a, 'b', {_shifted(key, tag, 's.b', 'r', 's.a')})))"
    )
    return _bind(x, "w", (
        f"CASE WHEN length(w) = 0 THEN w WHEN length(w) = 1 THEN {_shifted(key, tag, 'w', '0', chr(39) * 2)} "
        f"ELSE {_bind(pair, 'h', 'concat(h.a, h.b)')} END"
    ))


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _refilled(form: str, digits: str) -> str:
    """``form`` with its digits replaced, in order, by ``digits``."""
    return _bind(digits, "d", (
        f"array_join(transform(sequence(1, length({form})), j -> IF(substr({form}, j, 1) BETWEEN '0' AND '9', "
        f"substr(d, length({_digits(f'substr({form}, 1, j)')}), 1), substr({form}, j, 1))), '')"
    ))


def _luhn(x: str, doubled: int) -> str:
    """Luhn sum; ``doubled``: 0 if the last digit is doubled, 1 if the one before it."""
    v = f"CAST(substr({x}, length({x}) - k, 1) AS INT)"
    return (
        f"aggregate(sequence(0, length({x}) - 1), 0L, (t, k) -> t + IF(k % 2 = {doubled}, "
        f"({v} * 2) DIV 10 + ({v} * 2) % 10, {v}))"
    )


def _mod97(x: str) -> str:
    """Rest by 97 of a string of digits and capitals read as numbers 10 to 35."""
    c = f"substr({x}, k, 1)"
    return (
        f"aggregate(sequence(1, length({x})), 0, (t, k) -> IF({c} BETWEEN '0' AND '9', "
        f"(t * 10 + ascii({c}) - 48) % 97, (t * 100 + ascii({c}) - 55) % 97))"
    )


def _date(key: str, day: str, show: str) -> str:
    """Pseudonym of a date ``day``; ``show`` gives its text from the date p."""
    n = f"datediff({day}, {_FIRST_DAY})"
    moved = _pair(key, "date", f"{n} DIV {_DAY_B}", f"{n} % {_DAY_B}", _DAY_A, _DAY_B)
    return _bind(f"date_add({_FIRST_DAY}, CAST({_bind(moved, 'h', f'h.a * {_DAY_B} + h.b')} AS INT))", "p", show)


def _pseudonym(key: str, m: str) -> str:
    """The pseudonym of one match, or the match itself where it is not valid."""
    whole = lambda pattern: f"{m} RLIKE {_quoted('^(?:' + pattern + ')$')}"
    mail = f"concat({_characters(key, 'mail', f'substring_index({m}, {_quoted(chr(64))}, 1)')}, '@', substring_index({m}, '@', -1))"
    head = f"regexp_extract({m}, {_quoted('^' + _SECRET_HEAD)}, 0)"
    # long ones in parts of 512 characters, as the work grows with the square of a part
    parts = f"regexp_extract_all(substr({m}, length(g) + 1), '.{{1,512}}', 0)"
    secret = _bind(head, "g", f"concat(g, array_join(transform({parts}, part -> {_characters(key, 'secret', 'part')}), ''))")
    access = f"concat('AKIA', {_characters(key, 'access', f'substr({m}, 5)')})"

    plain = f"replace({m}, ' ', '')"
    moved = _characters(key, "iban", f"substr({plain}, 5)")
    check = _bind(f"{_mod97('q')}", "c", "lpad(CAST(98 - c AS STRING), 2, '0')")
    iban = _bind(moved, "bban", _bind(f"concat(bban, substr({m}, 1, 2), '00')", "q", f"concat(substr({m}, 1, 2), {check}, bban)"))
    iban_ok = _bind(f"concat(substr({plain}, 5), substr({plain}, 1, 4))", "q", f"{_mod97('q')} = 1")
    printed = f"regexp_replace({iban}, '(.{{4}})(?=.)', '$1 ')"

    octets = f"split({m}, '[.]')"
    address_ok = f"forall({octets}, o -> CAST(o AS INT) <= 255 AND CAST(CAST(o AS INT) AS STRING) = o)"
    o = [f"CAST(element_at(o, {i}) AS BIGINT)" for i in range(1, 5)]
    address = _bind(octets, "o", _bind(
        _pair(key, "address", f"{o[0]} * 256 + {o[1]}", f"{o[2]} * 256 + {o[3]}", 65536, 65536), "h",
        "concat_ws('.', CAST(h.a DIV 256 AS STRING), CAST(h.a % 256 AS STRING), CAST(h.b DIV 256 AS STRING), CAST(h.b % 256 AS STRING))",
    ))

    def day(y: str, mo: str, d: str) -> str:
        return f"try_cast(concat({y}, '-', lpad({mo}, 2, '0'), '-', lpad({d}, 2, '0')) AS DATE)"

    part = [f"element_at(split({m}, '[-/.]'), {i})" for i in (1, 2, 3)]
    sep = f"regexp_extract({m}, '[-/.]', 0)"
    shown = lambda f: f"date_format(p, '{f}')"
    ymd = day(part[0], part[1], part[2])
    ymd_out = _date(key, ymd, f"concat_ws({sep}, {shown('yyyy')}, {shown('MM')}, {shown('dd')})")
    # month first with slashes, day first else; the other order where only that is a date
    mdy, dmy = day(part[2], part[0], part[1]), day(part[2], part[1], part[0])
    padded = f"length({m}) = 10"
    two = lambda f: f"IF({padded}, {shown(f * 2)}, {shown(f)})"
    mdy_out = _date(key, mdy, f"concat_ws({sep}, {two('M')}, {two('d')}, {shown('yyyy')})")
    dmy_out = _date(key, dmy, f"concat_ws({sep}, {two('d')}, {two('M')}, {shown('yyyy')})")
    slash = f"{sep} = '/'"

    s = [f"CAST(element_at(split({m}, '-'), {i}) AS INT)" for i in (1, 2, 3)]
    social_ok = f"{s[0]} BETWEEN 1 AND 899 AND {s[0]} <> 666 AND {s[1]} > 0 AND {s[2]} > 0"
    area = f"{s[0]} - IF({s[0]} > 666, 2, 1)"
    social = _bind(
        _pair(key, "social", area, f"({s[1]} - 1) * 9999 + {s[2]} - 1", 898, 99 * 9999), "h",
        "concat_ws('-', lpad(CAST(h.a + IF(h.a >= 665, 2, 1) AS STRING), 3, '0'), "
        "lpad(CAST(h.b DIV 9999 + 1 AS STRING), 2, '0'), lpad(CAST(h.b % 9999 + 1 AS STRING), 4, '0'))",
    )
    ten = f"right({_digits(m)}, 10)"
    national = _refilled(m, _bind(ten, "n", _bind(
        _pair(key, "national", "CAST(substr(n, 1, 3) AS BIGINT) - 200",
              "(CAST(substr(n, 4, 3) AS BIGINT) - 200) * 10000 + CAST(substr(n, 7, 4) AS BIGINT)", 800, 8_000_000), "h",
        f"concat(left({_digits(m)}, length({_digits(m)}) - 10), CAST(200 + h.a AS STRING), "
        "CAST(200 + h.b DIV 10000 AS STRING), lpad(CAST(h.b % 10000 AS STRING), 4, '0'))",
    )))
    abroad = _refilled(m, f"concat(left({_digits(m)}, 2), {_characters(key, 'abroad', f'substr({_digits(m)}, 3)')})")

    return (
        f"CASE WHEN {whole(_MAIL)} THEN {mail} WHEN {whole(_SECRET)} THEN {secret} WHEN {whole(_ACCESS_KEY)} THEN {access} "
        f"WHEN {whole(_PRINTED_IBAN)} THEN IF({iban_ok}, {printed}, {m}) WHEN {whole(_IBAN)} THEN IF({iban_ok}, {iban}, {m}) "
        f"WHEN {whole(_ADDRESS)} THEN IF({address_ok}, {address}, {m}) "
        f"WHEN {whole(_YMD)} THEN IF({ymd} IS NOT NULL, {ymd_out}, {m}) "
        f"WHEN {whole(_DMY.replace(chr(92) + '2', chr(92) + '1'))} THEN CASE WHEN {slash} AND {mdy} IS NOT NULL THEN {mdy_out} "
        f"WHEN {dmy} IS NOT NULL THEN {dmy_out} WHEN {mdy} IS NOT NULL THEN {mdy_out} ELSE {m} END "
        f"WHEN {whole(_SOCIAL)} THEN IF({social_ok}, {social}, {m}) WHEN {whole(_NATIONAL)} THEN {national} "
        f"WHEN {whole(_ABROAD)} THEN {abroad} ELSE {m} END"
    )


def _woven(gaps: str, values: str) -> str:
    """Gaps and the values between them as one string."""
    return f"array_join(zip_with({gaps}, {values}, (g, v) -> concat(g, coalesce(v, ''))), '')"


def _cards(key: str, x: str) -> str:
    """``x`` with its cards replaced and their number: struct with t and n.

    In a run of groups of digits, a card may start and end at any border of groups.
    """
    # the first digit tells the kind of card and stays; the last one is the check digit
    body = f"concat(left({_digits('m')}, 1), {_characters(key, 'card', f'substr({_digits('m')}, 2, length({_digits('m')}) - 2)')})"
    card = _refilled("m", _bind(body, "b", f"concat(b, CAST((10 - {_luhn('b', 0)} % 10) % 10 AS STRING))"))
    some = ", ".join(f"regexp_extract(c, {_quoted(_CARD_OF % (n - 1))}, 0)" for n in range(19, 12, -1))
    ok = f"p <> '' AND {_bind(_digits('p'), 'n', f'{_luhn('n', 1)} % 10 = 0')}"
    best = f"coalesce(get(filter(array({some}), p -> {ok}), 0), '')"
    cards = f"array_distinct(filter(transform(regexp_extract_all(u, {_quoted(_CARDS_AT)}, 1), c -> {best}), p -> p <> ''))"
    exact = f"concat('(?<![A-Za-z0-9])(?:', array_join(cs, '|'), ')(?![A-Za-z0-9])')"
    changed = _bind(exact, "e", _bind("regexp_extract_all(u, e, 0)", "fs", (
        f"named_struct('t', {_woven('split(u, e, -1)', f'transform(fs, m -> {card})')}, 'n', size(fs))"
    )))
    run = _bind(cards, "cs", f"IF(size(cs) = 0, named_struct('t', u, 'n', 0), {changed})")
    runs = f"transform(regexp_extract_all({x}, {_quoted(_RUN)}, 0), u -> {run})"
    return f"IF({x} RLIKE '[0-9][0-9 -]{{12}}', " + _bind(runs, "rs", (
        f"named_struct('t', {_woven(f'split({x}, {_quoted(_RUN)}, -1)', 'transform(rs, o -> o.t)')}, "
        f"'n', aggregate(rs, 0, (a, o) -> a + o.n))"
    )) + f", named_struct('t', {x}, 'n', 0))"


def pseudonymise(
    df: DataFrame, key: str, text: str = "text", n_replaced: str = "n_replaced"
) -> DataFrame:
    """Replace ``text`` by itself with pseudonyms, and append how many values were replaced.

    Mail addresses keep their domain, cards their first digit, telephone numbers their
    country code, IBANs their country and grouping, dates stay within 1800 to 2199 and keep their order
    and separators (month first with slashes, day first else).  Values that fail their
    check are left alone; a card is found beside other numbers of its run of digits.  A null text stays null with 0 replacements; the rest of every
    text stays as it is.  Other columns pass through; one called ``n_replaced`` is replaced.
    Everything is an expression of the row: no shuffle, no Python.
    """
    ready(df.sparkSession)
    kept = [c for c in df.columns if c.lower() not in (text.lower(), n_replaced.lower())]
    t, found, made, parts = (fresh(df.columns, [f"_{i}"]) for i in range(4))
    pattern = _quoted(PATTERN)
    # only texts with a digit or a mail sign can hold a value
    may = f"{t} RLIKE '[0-9@]'"
    gaps = f"IF(size({found}) > 0, split({t}, {pattern}, -1), array({t}))"
    values = f"zip_with({found}, {made}, (f, v) -> named_struct('t', v, 'd', f <> v))"
    # what is between the values, and each value; d: replaced already
    whole = (
        f"flatten(zip_with({gaps}, {values}, (g, v) -> array(named_struct('t', g, 'd', false), "
        "coalesce(v, named_struct('t', '', 'd', false)))))"
    )
    out = (
        df.select(*(df[f"`{c}`"] for c in kept), F.col(f"`{text}`").cast("string").alias(t))
        .withColumn(found, F.expr(f"IF({may}, regexp_extract_all({t}, {pattern}, 0), array())"))
        .withColumn(made, F.expr(f"IF(size({found}) > 0, transform({found}, m -> {_pseudonym(key, 'm')}), array())"))
        .withColumn(parts, F.expr(f"IF({may}, transform({whole}, z -> IF(z.d, named_struct('t', z.t, 'n', 1), {_cards(key, 'z.t')})), array())"))
    )
    result = out.select(
        *kept, F.expr(f"IF(size({parts}) > 0, array_join(transform({parts}, z -> z.t), ''), {t})").alias(text),
        F.expr(f"IF({t} IS NULL, 0, aggregate({parts}, 0, (a, z) -> a + z.n))").cast("int").alias(n_replaced),
    )
    return result.select(*(c for c in df.columns if c.lower() != n_replaced.lower()), n_replaced)
