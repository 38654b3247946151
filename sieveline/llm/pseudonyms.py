"""Format-preserving pseudonyms for validated personal numbers, dates and secrets."""

import datetime
import hashlib
import re

import pyarrow as pa

ROUNDS = 10

RESULT = "doc_id long, text string, n_replaced long, spans array<struct<kind:string,start:int,end:int>>"


class Permutation:
    """Keyed permutations of the numbers below any bound.

    A balanced Feistel network over the next even number of bits, walked until
    the result is below the bound. `kind` and the bound are part of the key.
    """

    def __init__(self, key):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, n, half, tweak, value):
        size = (half + 7) // 8
        message = tweak + bytes([n]) + value.to_bytes(size, "big")
        digest = hashlib.blake2b(message, key=self.key, digest_size=min(64, size + 8)).digest()
        return int.from_bytes(digest, "big") & ((1 << half) - 1)

    def __call__(self, kind, value, bound):
        return self._walk(kind, value, bound, range(ROUNDS), self._forth)

    def inverse(self, kind, value, bound):
        return self._walk(kind, value, bound, range(ROUNDS - 1, -1, -1), self._back)

    def _walk(self, kind, value, bound, rounds, step):
        if not 0 <= value < bound:
            raise ValueError("value is outside its format")
        half = max(1, ((bound - 1).bit_length() + 1) // 2)
        tweak = f"{kind}/{bound}/".encode()
        while True:
            left, right = value >> half, value & ((1 << half) - 1)
            for n in rounds:
                left, right = step(n, half, tweak, left, right)
            value = left << half | right
            if value < bound:
                return value

    def _forth(self, n, half, tweak, left, right):
        return right, left ^ self._round(n, half, tweak, right)

    def _back(self, n, half, tweak, left, right):
        return right ^ self._round(n, half, tweak, left), left


def _refilled(original, characters, wanted):
    """`original` with its characters of the class `wanted` replaced in turn."""
    rest = iter(characters)
    return "".join(next(rest) if wanted(c) else c for c in original)


def _digits(value):
    return "".join(filter(str.isdigit, value))


def luhn_digit(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        doubled = int(c) * (2 if i % 2 == 0 else 1)
        total += doubled - 9 if doubled > 9 else doubled
    return str(-total % 10)


def card(value, permute):
    """All digits but the last are permuted, the check digit follows from them."""
    digits = _digits(value)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    payload = f"{permute('card', int(digits[:-1]), 10 ** (len(digits) - 1)):0{len(digits) - 1}d}"
    return _refilled(value, payload + luhn_digit(payload), str.isdigit)


def _iban_number(value):
    return int("".join(str(int(c, 36)) for c in value))


def iban(value, permute):
    """Digits permute among digits and letters among letters; country and kind of each place stay, check digits follow."""
    plain = value.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or _iban_number(account + country + check) % 97 != 1:
        return None
    number, bound = 0, 1
    for c in account:
        base, low = (10, "0") if c.isdigit() else (26, "A")
        number, bound = number * base + ord(c) - ord(low), bound * base
    number = permute(f"iban {country} " + "".join("9" if c.isdigit() else "A" for c in account), number, bound)
    places = []
    for c in reversed(account):
        base, low = (10, "0") if c.isdigit() else (26, "A")
        number, rest = divmod(number, base)
        places.append(chr(ord(low) + rest))
    account = "".join(reversed(places))
    check = f"{98 - _iban_number(account + country + '00') % 97:02d}"
    return _refilled(value, country + check + account, str.isalnum)


def ip(value, permute):
    number = int.from_bytes(bytes(map(int, value.split("."))), "big")
    return ".".join(map(str, permute("ip", number, 1 << 32).to_bytes(4, "big")))


def _plan_number(digits, permute):
    """A number of the ten-digit plan: area and exchange begin with 2 to 9."""
    if len(digits) != 10 or digits[0] < "2" or digits[3] < "2":
        return None
    number = (int(digits[:3]) - 200) * 8_000_000 + (int(digits[3:6]) - 200) * 10_000 + int(digits[6:])
    number = permute("phone", number, 800 * 800 * 10_000)
    number, line = divmod(number, 10_000)
    area, exchange = divmod(number, 800)
    return f"{area + 200}{exchange + 200}{line:04d}"


def _other_number(digits, permute):
    """Ten digits that the plan does not have, permuted among all such."""
    while True:
        digits = f"{permute('phone 1', int(digits), 10**10):010d}"
        if digits[0] < "2" or digits[3] < "2":
            return digits


def phone(value, permute):
    """With +1, or with parentheses, any ten digits are a number; else only those of the ten-digit plan."""
    digits = _digits(value)
    if value[0] != "+" or digits[0] == "1" and len(digits) == 11:
        own = _plan_number(digits[-10:], permute)
        if own is None and value[0] in "+(":
            own = _other_number(digits[-10:], permute)
        return own and _refilled(value, digits[:-10] + own, str.isdigit)
    # Other countries: the last seven digits or more after a code of up to three.
    keep = min(3, len(digits) - 7)
    own = f"{permute(f'phone {digits[:keep]}', int(digits[keep:]), 10 ** (len(digits) - keep)):0{len(digits) - keep}d}"
    return _refilled(value, digits[:keep] + own, str.isdigit)


def ssn(value, permute):
    area, group, serial = int(value[:3]), int(value[4:6]), int(value[7:])

    def valid(a, g, s):
        return 0 < a < 900 and a != 666 and g > 0 and s > 0

    if not valid(area, group, serial):
        return None
    number = area * 1_000_000 + group * 10_000 + serial
    while True:
        number = permute("ssn", number, 10**9)
        parts = number // 1_000_000, number // 10_000 % 100, number % 10_000
        if valid(*parts):
            return "{:03d}{}{:02d}{}{:04d}".format(parts[0], value[3], parts[1], value[6], parts[2])


FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal()


def _written(part):
    """How a month or day is written: with one digit, with two, or with a zero before one."""
    return "one" if len(part) == 1 else "zero" if part[0] == "0" else "two"


def date(value, permute):
    """A calendar day of 1900 to 2099, in the order year-month-day, month/day/year, or day.month.year.

    With slashes, days above 12 in the first place are read as day/month/year and
    permuted among such days. If a part has one digit, days are permuted among those
    whose month and day are written like them.
    """
    parts = re.split("([-/.])", value)
    order = "ymd" if len(parts[0]) == 4 else "dmy" if "." in value or int(parts[0]) > 12 else "mdy"
    given = dict(zip(order, parts[::2]))
    try:
        ordinal = datetime.date(*(int(given[part]) for part in "ymd")).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= ordinal < LAST_DAY:
        return None
    late = order == "dmy" and "." not in value
    kind = "late date" if late else "date"
    forms = tuple(_written(given[part]) for part in "md")
    if "one" in forms:
        kind = " ".join((kind, *forms))
    while True:
        ordinal = FIRST_DAY + permute(kind, ordinal - FIRST_DAY, LAST_DAY - FIRST_DAY)
        found = datetime.date.fromordinal(ordinal)
        own = {"y": f"{found.year}", "m": f"{found.month:02d}", "d": f"{found.day:02d}"}
        if "one" in forms:
            own |= {part: f"{number}" for part, number, form in zip("md", (found.month, found.day), forms) if form == "one"}
            if tuple(_written(own[part]) for part in "md") != forms:
                continue
        if not late or found.day > 12:
            return "".join([own[order[0]], parts[1], own[order[1]], parts[3], own[order[2]]])


def email(value, permute):
    """The name before the @, each character within its kind; the domain stays."""
    name, at, domain = value.partition("@")
    return _characters("email " + domain.lower(), name, permute) + at + domain


def secret(value, permute):
    """Each character within its kind: digits or letters of a hexadecimal number, else digits, lower or upper case letters."""
    head, *rest = re.split(r"""(["']?\s*[=:]\s*["']?)""", value, maxsplit=1)
    if rest:
        return head + rest[0] + _characters("secret", rest[1], permute)
    return value[:4] + _characters("key", value[4:], permute)


# Longer values are permuted in blocks of so many characters.
BLOCK = 128


def _hexadecimal(value):
    """"hex" or "HEX" if `value` is a hexadecimal number of more than eight digits; "HEX" has a capital letter."""
    if len(value) > 8:
        return next((kind for kind, own in (("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF")) if not value.strip(own)), None)


def _characters(kind, value, permute):
    """Each character within its kind; hexadecimal numbers of either case stay such, and no other value becomes one."""
    digits, result = _hexadecimal(value), value
    while True:
        blocks, after = [], ""
        for start in range(0, len(result), BLOCK):
            # The key of a block includes the block before, as it is written.
            blocks.append(_block(kind, digits, after, result[start : start + BLOCK], permute))
            after = f" after {blocks[-1]}"
        result = "".join(blocks)
        if _hexadecimal(result) == digits:
            return result


def _block(kind, digits, after, value, permute):
    if digits:
        own = f"{permute(f'{digits} {len(value)}{after}', int(value, 16), 16 ** len(value)):0{len(value)}x}"
        return own.upper() if digits == "HEX" else own
    kinds = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    number, bound, places = 0, 1, []
    for c in value:
        own = next((alphabet for alphabet in kinds if c in alphabet), None)
        places.append(own)
        if own:
            number, bound = number * len(own) + own.index(c), bound * len(own)
    shape = "".join(str(kinds.index(own)) if own else c for c, own in zip(value, places))
    number = permute(f"{kind} {shape}{after}", number, bound) if bound > 1 else 0
    result = []
    for c, own in zip(reversed(value), reversed(places)):
        if own:
            number, rest = divmod(number, len(own))
            c = own[rest]
        result.append(c)
    return "".join(reversed(result))


OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# The earlier of two kinds wins where both begin.
KINDS = {
    "email": (email, r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![\w-])"),
    "ip": (ip, rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\w)"),
    "date": (date, r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([/.])\d{1,2}\2\d{4})(?!(?!T\d)[\w/-]|\.\d)"),
    "ssn": (ssn, r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])"),
    "card": (card, r"(?<![\w-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])"),
    "iban": (iban, r"(?<!\w)[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)"),
    "phone": (phone, r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![\w+])\+\d(?:[ .-]?\d){7,14}(?![\w-])"),
    "secret": (
        secret,
        r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)"
        # The end of a name, which may be quoted, and a value: a quoted one without blanks, one of letters and
        # digits, or up to a blank if it has a digit. The signs that end a sentence do not belong to it.
        r"|(?i:password|passwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*"
        r"(?:[\"'][^\s\"']{8,}(?=[\"'])|[\"']?(?:(?=[^\s\"']*\d)[^\s\"',;<>]{11,}[A-Za-z0-9=/+_-]|[A-Za-z0-9]{12,}(?!\w)))",
    ),
}


def _numbered(patterns):
    """The patterns as named groups of one, with their own groups renumbered."""
    parts, before = [], 0
    for kind, pattern in patterns.items():
        own = re.compile(pattern).groups
        before += 1
        parts.append(f"(?P<{kind}>" + re.sub(r"\\([1-9])", lambda m, b=before: f"\\{b + int(m[1])}", pattern) + ")")
        before += own
    return re.compile("|".join(parts), re.ASCII)


# Texts without any of these hold nothing to replace.
CANDIDATE = re.compile(r"[0-9@]|AKIA|(?i:passw|secret|token|api[_-]?key|access[_-]?key)", re.ASCII)
FOUND = _numbered({kind: pattern for kind, (_, pattern) in KINDS.items()})


def pseudonymised(text, permute):
    """The text with pseudonyms, and (kind, start, end) of what was replaced, in code points of the given text."""
    parts, spans, done, at = [], [], 0, 0
    while match := FOUND.search(text, at):
        kind = match.lastgroup
        own = KINDS[kind][0](match[0], permute)
        if own is None:
            # Not valid: look again behind its first character, something else may begin there.
            at = match.start() + 1
            continue
        parts += text[done : match.start()], own
        spans.append((kind, match.start(), match.end()))
        done = at = match.end()
    return ("".join([*parts, text[done:]]), spans) if spans else (text, spans)


def pseudonyms(docs, key):
    """(doc_id, text, n_replaced, spans) per row of `docs`.

    E-mail names, IPv4 addresses, calendar dates, US social security numbers,
    payment cards (Luhn), IBANs (mod 97), phone numbers, access keys and secrets
    that are valid (ten digits without +1 or parentheses only where area and exchange begin with
    2 to 9) are replaced in place by values of the same format and
    validity, permuted under `key` (bytes). So equal values have equal
    pseudonyms in all documents, different ones different, and the holder of the key
    can invert them; separators stay as written. All other text stays as it is.
    `spans` are (kind, start, end) in code points of the original text.

    Whole texts are searched, one at a time. Null text stays null, with no spans;
    an empty table gives no rows; repeated rows are treated alike.
    """
    permute_key = bytes(key)

    def run(batches):
        permute = Permutation(permute_key)
        for batch in batches:
            texts, spans = [], []
            for value in batch.column(1):
                text = value.as_py()
                if text is not None and CANDIDATE.search(text):
                    text, found = pseudonymised(text, permute)
                else:
                    found = []
                texts.append(text)
                spans.append([{"kind": kind, "start": start, "end": end} for kind, start, end in found])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            counts = pa.array([len(found) for found in spans], pa.int64())
            columns = [batch.column(0), pa.array(texts, pa.string()), counts, pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_replaced", "spans"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, RESULT)
