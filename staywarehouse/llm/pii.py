"""PII: format-preserving pseudonyms by keyed Feistel permutations, in Spark expressions alone.

Found values are replaced in place by values of the same format, the same one for equal values in
any document. Numbers are validated and stay valid: cards keep length, separators and a right
check digit; social security numbers their ranges; North American phones their area and exchange
ranges (other phones their country code); IPv4 addresses four octets; dates are calendar days and
become days of the same 400-year cycle. Mail addresses keep their domain and the pattern of
letters, digits and marks before it. What is not valid stays as it is.

The permutation: a value is two numbers (a, b) below (u, v); ten rounds add to one of them a keyed
hash of the other, modulo its bound. Every round can be undone, so different values never meet.

Defined results: null stays null; a text without values stays byte for byte; what only looks like
a value (a day that no calendar has, a card number of a wrong check digit) stays and is not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10

# The formats that are searched for, in the order in which they are tried.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "mail": rf"(?<!{_LOCAL}){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}+",
    "date": r"(?<!\d)(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?!\d)",
    "social": r"(?<!\d)\d{3}-\d\d-\d{4}(?!\d)",
    "phone": r"(?:\+1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<!\d)(?:\+1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?!\d)"
             r"|\+\d{1,3}[ .-]\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\.?\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
    "address": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}"
               r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Days of the 400-year cycle of the calendar: 146097 = 189 x 773.
CYCLE = (189, 773)


def _hash(key: str, kind: str, turn: str, value: str) -> str:
    message = f"concat_ws('|', '{key}', {kind}, {turn}, {value})"
    return f"cast(conv(substr(sha2({message}, 256), 1, 15), 16, 10) AS bigint)"


def feistel(key: str, kind: str, a: str, b: str, u: str, v: str) -> str:
    """SQL for struct(a, b) permuted; kind, a, b, u and v are SQL."""
    turn = "cast(turn AS string)"
    left = f"pmod(s.a + {_hash(key, kind, turn, 'cast(s.b AS string)')}, cast({u} AS bigint))"
    right = f"pmod(s.b + {_hash(key, kind, turn, 'cast(s.a AS string)')}, cast({v} AS bigint))"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('a', cast({a} AS bigint), 'b', "
            f"cast({b} AS bigint)), (s, turn) -> if(turn % 2 = 1, "
            f"named_struct('a', {left}, 'b', s.b), named_struct('a', s.a, 'b', {right})))")


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` in which ``name`` stands for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _padded(value: str, width: str) -> str:
    return f"lpad(cast({value} AS string), {width}, '0')"


def _relaid(digits: str, m: str) -> str:
    """SQL for ``m`` with its digits replaced in turn by those of ``digits``."""
    return (f"aggregate(sequence(1, length({m})), named_struct('o', '', 'i', 1), (s, k) -> "
            f"if(substr({m}, k, 1) BETWEEN '0' AND '9', "
            f"named_struct('o', concat(s.o, substr({digits}, s.i, 1)), 'i', s.i + 1), "
            f"named_struct('o', concat(s.o, substr({m}, k, 1)), 'i', s.i)), s -> s.o)")


def _digits(key: str, kind: str, d: str) -> str:
    """SQL for the digit string ``d`` (up to 36 digits) permuted among those of its length."""
    half = f"(length({d}) div 2)"
    size = f"cast(power(10, {half}) AS bigint)"
    rest = f"cast(power(10, length({d}) - {half}) AS bigint)"
    found = feistel(key, f"concat('{kind}', length({d}))", f"substr({d}, 1, {half})",
                    f"substr({d}, {half} + 1)", size, rest)
    return _let("f", found, f"concat({_padded('f.a', half)}, "
                            f"{_padded('f.b', f'length({d}) - {half}')})")


def _card(key: str) -> str:
    right = "filter(sequence(0, 9), c -> luhn_check(concat(p, cast(c AS string))))[0]"
    body = _let("p", _digits(key, "card", "left(d, length(d) - 1)"),
                _let("n", f"concat(p, cast({right} AS string))", _relaid("n", "m")))
    return _let("d", "regexp_replace(m, '[^0-9]', '')", f"if(luhn_check(d), {body}, m)")


def _social(key: str) -> str:
    area, group, serial = ("cast(substr(m, 1, 3) AS bigint)", "cast(substr(m, 5, 2) AS bigint)",
                           "cast(substr(m, 8, 4) AS bigint)")
    valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
    found = feistel(key, "'social'", f"{area} - if({area} > 666, 2, 1)",
                    f"({group} - 1) * 9999 + {serial} - 1", "898", "989901")
    made = _let("f", found, f"concat({_padded('f.a + if(f.a >= 665, 2, 1)', '3')}, '-', "
                            f"{_padded('f.b div 9999 + 1', '2')}, '-', "
                            f"{_padded('f.b % 9999 + 1', '4')})")
    return f"if({valid}, {made}, m)"


def _phone(key: str) -> str:
    """The country code stays; ten digits of the North American plan stay in the plan."""
    code = "regexp_extract(m, r'^\\+(?:1(?=[^0-9])|[0-9]{1,3}(?=[^0-9]))', 0)"
    plan = feistel(key, "'plan'", "cast(substr(d, 1, 3) AS bigint) - 200",
                   "(cast(substr(d, 4, 3) AS bigint) - 200) * 10000 + "
                   "cast(substr(d, 7) AS bigint)", "800", "8000000")
    plan = _let("f", plan, f"concat(cast(f.a + 200 AS string), "
                           f"cast(f.b div 10000 + 200 AS string), "
                           f"{_padded('f.b % 10000', '4')})")
    own = "(c IN ('', '+1') AND length(d) = 10 AND substr(d, 1, 1) >= '2'" \
          " AND substr(d, 4, 1) >= '2')"
    made = _let("n", f"if({own}, {plan}, {_digits(key, 'phone', 'd')})",
                f"concat(c, {_relaid('n', 'substr(m, length(c) + 1)')})")
    return _let("c", code, _let("d", "regexp_replace(substr(m, length(c) + 1), '[^0-9]', '')",
                                made))


def _address(key: str) -> str:
    part = "cast(split(m, '[.]')[{}] AS bigint)".format
    found = feistel(key, "'address'", f"{part(0)} * 256 + {part(1)}",
                    f"{part(2)} * 256 + {part(3)}", "65536", "65536")
    return _let("f", found, "concat_ws('.', f.a div 256, f.a % 256, f.b div 256, f.b % 256)")


def _date(key: str) -> str:
    """Days are counted in the cycle of 400 years that begins with 2000, or a multiple off.

    What is no date with the month first is read, and written, with the day first.
    """
    form = ("CASE WHEN m RLIKE '^[0-9]{4}-' THEN 'yyyy-MM-dd' WHEN m RLIKE '^[0-9]{4}/' THEN "
            "'yyyy/MM/dd' WHEN m LIKE '%.%' THEN 'dd.MM.yyyy' WHEN "
            "try_to_timestamp(m, 'MM/dd/yyyy') IS NULL THEN 'dd/MM/yyyy' ELSE 'MM/dd/yyyy' END")
    days = CYCLE[0] * CYCLE[1]
    found = feistel(key, "'date'", f"pmod(n, {days}) div {CYCLE[1]}",
                    f"pmod(n, {days}) % {CYCLE[1]}", str(CYCLE[0]), str(CYCLE[1]))
    new = (f"date_format(date_add(DATE'2000-01-01', cast(n - pmod(n, {days}) + "
           f"f.a * {CYCLE[1]} + f.b AS int)), form)")
    made = _let("n", "cast(datediff(whole, DATE'2000-01-01') AS bigint)", _let("f", found, new))
    return _let("form", form, _let("whole", "cast(try_to_timestamp(m, form) AS date)",
                                   f"if(whole IS NULL OR year(whole) < 1, m, {made})"))


def _mail(key: str) -> str:
    """Each half of the part before the @ is shifted, sign by sign, by hashes of the other."""
    def shifted(own: str, other: str) -> str:
        by = (f"cast(conv(substr(sha2(concat_ws('|', '{key}', 'mail', cast(turn AS string), "
              f"{other}, cast(i div 16 AS string)), 256), 1 + 4 * (i % 16), 4), 16, 10) AS int)")
        signs = " ".join(
            f"WHEN c BETWEEN '{a}' AND '{z}' THEN chr({ord(a)} + (ascii(c) - {ord(a)} + {by})"
            f" % {ord(z) - ord(a) + 1})" for a, z in ("09", "az", "AZ"))
        return f"array_join(transform(split({own}, ''), (c, i) -> CASE {signs} ELSE c END), '')"

    local = "substring_index(m, '@', 1)"
    start = (f"named_struct('a', left({local}, length({local}) div 2), "
             f"'b', substr({local}, length({local}) div 2 + 1))")
    made = (f"aggregate(sequence(1, {ROUNDS}), {start}, (s, turn) -> if(turn % 2 = 1, "
            f"named_struct('a', {shifted('s.a', 's.b')}, 'b', s.b), "
            f"named_struct('a', s.a, 'b', {shifted('s.b', 's.a')})), s -> concat(s.a, s.b))")
    return f"concat({made}, substr(m, length({local}) + 1))"


def pseudonym(key: str) -> str:
    """SQL for the pseudonym of a found value ``m``."""
    if "'" in key or "\\" in key or not key:
        raise ValueError("the key must be text without quotes and backslashes")
    made = {"mail": _mail, "date": _date, "social": _social, "phone": _phone, "card": _card,
            "address": _address}
    tests = {"mail": "m LIKE '%@%'",
             "date": "m RLIKE '^([0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[./][0-9]{2}[./]"
                     "[0-9]{4})$'",
             "social": "m RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'",
             "address": "m RLIKE '^[0-9]{1,3}([.][0-9]{1,3}){3}$'",
             "card": "m RLIKE '^([0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}"
                     "|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$'",
             "phone": "true"}
    cases = " ".join(f"WHEN {test} THEN {made[kind](key)}" for kind, test in tests.items())
    return f"CASE {cases} END"


def hidden(text: str, key: str) -> Column:
    """A struct of column ``text`` with pseudonyms, and ``pseudonyms``, in order.

    Values of a format that are not valid (no date, no card number) stay and are not listed. The
    column is named once, outside of all lambdas, so that none of their names can hide it.
    """
    column = "`" + text.replace("`", "``") + "`"
    made = f"transform(found, m -> {pseudonym(key)})"
    joined = (f"array_join(zip_with(split(whole, r'{ANY}'), made, (p, o) -> "
              "concat(coalesce(p, ''), coalesce(o, ''))), '')")
    new = "filter(made, (o, i) -> o <> found[i])"
    body = _let("made", made, f"named_struct('text', if(size(made) = 0, whole, {joined}), "
                              f"'pseudonyms', {new})")
    return F.expr(_let("whole", column, _let(
        "found", f"regexp_extract_all(whole, r'{ANY}', 0)", body)))


def pseudonymise(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``documents`` with the values in column ``text`` replaced."""
    return documents.withColumn(text, hidden(text, key)["text"])


def report(documents: DataFrame, key: str) -> DataFrame:
    """Per row: doc_id, text (replaced), pseudonyms (array), n_found."""
    found = documents.select("doc_id", F.col("text").cast("string").alias("text")) \
        .select("doc_id", hidden("text", key).alias("found"))
    return found.select("doc_id", "found.text", "found.pseudonyms", F.expr(
        "cast(coalesce(size(found.pseudonyms), 0) AS bigint)").alias("n_found"))
