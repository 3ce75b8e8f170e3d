"""Secret scans: patterns, and encoded candidates that are decoded and parsed before they are reported."""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "pem", "der", "openssh", "jwt", "hexkey")

# Candidates of the structural checks. Every run is entered at its start only.
# A key's base64 begins with a sequence tag and a length, or with the OpenSSH magic; its lines are parted by breaks with
# white space and marks of quotation around them.
KEY_START = re.compile(r"[Mb](?<![A-Za-z0-9][Mb])(?:(?<=M)[A-I]|(?<=b)3B)")
PIECE = re.compile(r"[A-Za-z0-9+/_-]++")
# Between two lines of a key: a break, or the end of one string of a list and the start of the next.
BREAK = re.compile(r"""(?:[^\S\r\n]*+(?:[\r\n]++[^\S\r\n]*+(?:[>|#*][^\S\r\n]*+)*+)++|["'`]\s*+[,+\\]?+\s*+["'`])""")
PADDING = re.compile(r"(?:=|%3[dD]){1,2}")
KEY_LEAST = 32
# No private key is larger: a key of 65,536 bits takes 37 KB.
KEY_MOST = 1 << 16
# What source code and data files put between the lines of a PEM body: breaks, slashes and signs written as escapes, and quotes
# with signs of concatenation.
ESCAPED_BREAK = re.compile(r"(?<!\\)\\++(?:[rnt]|u000[aAdD9])")
ESCAPED_SIGN = re.compile(r"(?<!\\)\\++(?:u00(2[bBfF]|3[dD])|(?=/))")
QUOTES = re.compile(r"""["'`][^A-Za-z0-9/="'`_-]*+["'`]""")
AROUND = "\"'`,;>|#*()&.\\"
# Hex of a sequence or of the OpenSSH magic, its bytes side by side, parted by colons or blanks, or over lines.
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?<![0-9A-Fa-f]:)(?=30|6[fF][: ]?70)[0-9A-Fa-f]{2}(?:(?:[: ]|:?[^\S\r\n]*+[\r\n]++[^\S\r\n]*+)?[0-9A-Fa-f]{2}){47,}+")
HEX_BYTE = re.compile(r"[0-9A-Fa-f]{2}")
# A token's header is an object, with or without white space before its first name.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[yw][A-Za-z0-9_-]{10,}+(?:\.[A-Za-z0-9_-]*+){2,4}+")
# A PEM file that is base64 itself begins so, and percent codes stand for the signs of base64 and of PEM.
PEM_START = re.compile(r"(?<![A-Za-z0-9+/])LS0tLS1CRUdJTi")
PERCENT_RUN = re.compile(r"(?<![A-Za-z0-9%_-])[A-Za-z0-9+/_.~=-]*+(?:%[0-9A-Fa-f]{2}[A-Za-z0-9+/_.~=-]*+)++")
PERCENT = re.compile(r"%([0-9A-Fa-f]{2})")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]{1,12} ){0,3})PRIVATE KEY-----")
OPENSSH_MAGIC = b"openssh-key-v1\0"
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def decoded(text: str) -> bytes | None:
    """The bytes of a base64 text, in either alphabet, padded or not."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The tag-length-value elements that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at:at + n], "big")
            at += n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def is_key(data: bytes | None) -> bool:
    """Whether the bytes are a private key: one sequence whose nested lengths all fit, of one of the known forms."""
    if not data or data[0] != 0x30:
        return False
    outer = elements(data)
    if outer is None or len(outer) != 1:
        return False
    parts = elements(outer[0][1])
    if not parts or len(parts) < 3:
        return False
    tags = [t for t, _ in parts]
    if tags[0] != 0x02 or len(parts[0][1]) != 1 or parts[0][1][0] > 1:
        return False
    if len(parts) >= 9 and all(t == 0x02 for t in tags[:9]):
        return len(parts[1][1]) >= 32 and len(parts[3][1]) >= 16
    if len(parts) == 6 and all(t == 0x02 for t in tags):
        return len(parts[1][1]) >= 32
    if tags[1] == 0x30 and tags[2] == 0x04:
        named = elements(parts[1][1])
        return bool(named) and named[0][0] == 0x06 and len(parts[2][1]) >= 16
    if tags[1] == 0x04 and parts[0][1][0] == 1 and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return 16 <= len(parts[1][1]) <= 80 and all(elements(v) is not None for _, v in parts[2:])
    return False


def outer_size(data: bytes) -> tuple[int, bool]:
    """The size of the key that begins with these bytes, and True; or a larger number of bytes needed to tell, and False. 0 for no key."""
    if data[:1] == b"\x30":
        if len(data) < 2:
            return 2, False
        n = data[1] & 0x7F if data[1] >= 0x80 else 0
        if n > 4 or data[1] == 0x80:
            return 0, True
        if len(data) < 2 + n:
            return 2 + n, False
        return (2 + n + int.from_bytes(data[2:2 + n], "big") if n else 2 + data[1]), True
    if not data.startswith(OPENSSH_MAGIC):
        return 0, True
    at, left, counted = len(OPENSSH_MAGIC), 3, False
    while left:
        if at + 4 > len(data):
            return at + 4, False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        left -= 1
        if not left and not counted:
            if at + 4 > len(data):
                return at + 4, False
            keys = int.from_bytes(data[at:at + 4], "big")
            if not 1 <= keys <= 16:
                return 0, True
            # The public keys, then all private ones in one field.
            at, left, counted = at + 4, keys + 1, True
    return at, True


def is_openssh(data: bytes | None) -> bool:
    """Whether the bytes are an OpenSSH private key whose length-prefixed fields fill them exactly."""
    return bool(data) and data.startswith(OPENSSH_MAGIC) and outer_size(data) == (len(data), True)


@dataclass
class Block:
    """Lines of base64 that follow one another: their characters, where each line's lie in the text, and their bytes, decoded
    once for each of the four places in a group of characters at which a key may begin."""

    start: int
    end: int
    plain: str
    offsets: list[int]
    places: list[int]
    held: dict[int, bytes] = field(default_factory=dict)

    @classmethod
    def at(cls, text: str, start: int) -> Block:
        parts, offsets, places, at, size = [], [], [], start, 0
        while m := PIECE.match(text, at):
            parts.append(m[0])
            offsets.append(size)
            places.append(m.start())
            size, at = size + len(m[0]), m.end()
            if not (gap := BREAK.match(text, at)):
                break
            at = gap.end()
        last = places[-1] + len(parts[-1])
        return cls(start, last, "".join(parts).replace("-", "+").replace("_", "/"), offsets, places)

    def offset(self, place: int) -> int:
        """Where the character of the text lies among the block's."""
        k = bisect_right(self.places, place) - 1
        return self.offsets[k] + place - self.places[k]

    def place(self, offset: int) -> int:
        """The place in the text after so many of the block's characters."""
        k = bisect_left(self.offsets, offset) - 1
        return self.places[k] + offset - self.offsets[k]

    def bytes_from(self, offset: int) -> tuple[bytes, int]:
        """The bytes that hold those of a key from ``offset`` on, and where they begin."""
        shift = offset % 4
        if shift not in self.held:
            whole = self.plain[shift:]
            # A last group may be without its padding; a single character is none.
            whole = whole[:len(whole) - (len(whole) % 4 == 1)]
            self.held[shift] = base64.b64decode(whole + "=" * (-len(whole) % 4))
        return self.held[shift], (offset - shift) // 4 * 3


def outer_fits(data: bytes) -> int:
    """The size of the key that begins with these bytes, as far as its first lengths fit into one another; 0 if they do not."""
    n, known = outer_size(data)
    if not known:
        return n
    if not KEY_LEAST * 3 // 4 <= n <= KEY_MOST:
        return 0
    if data[0] != 0x30:
        return n
    at = 2 + (data[1] & 0x7F) * (data[1] >= 0x80)
    # Bytes that end within the version hold no key.
    if data[at:at + 3] not in (b"\x02\x01\x00", b"\x02\x01\x01"):
        return 0
    # The element after the version: its length has to end within the key.
    at += 3
    if len(data) >= at + 6:
        size, tag = data[at + 1], data[at]
        if tag not in (0x02, 0x30, 0x04):
            return 0
        if size >= 0x80:
            k = size & 0x7F
            if not 1 <= k <= 4:
                return 0
            size, at = int.from_bytes(data[at + 2:at + 2 + k], "big"), at + k
        if at + 2 + size > n:
            return 0
    return n


def key_at(text: str, start: int, block: Block) -> tuple[str, int] | None:
    """The kind and the end of the key whose base64 begins here: its own lengths say where it ends, which has to be the end of a run."""
    offset = block.offset(start)
    data, at = block.bytes_from(offset)
    n = outer_fits(data[at:at + 32])
    if not n or n > len(data) - at:
        return None
    if data[at] != 0x30:
        n, known = outer_size(data[at:at + KEY_MOST])
        if not known or n > min(KEY_MOST, len(data) - at):
            return None
    key = data[at:at + n]
    kind = "der" if is_key(key) else "openssh" if is_openssh(key) else None
    size = -(-n * 4 // 3)
    if not kind or offset + size > len(block.plain):
        return None
    end = block.place(offset + size)
    if PIECE.match(text, end):
        return None
    missing = -size % 4
    if m := PADDING.match(text, end):
        end, missing = m.end(), missing - m[0].count("=") - m[0].count("%")
    # Padding may be wrapped as well.
    if missing > 0 and (gap := BREAK.match(text, end)) and (m := PADDING.match(text, gap.end())) and m[0].count("=") + m[0].count("%") == missing:
        end = m.end()
    return kind, end


def first_bytes(text: str, start: int) -> bytes:
    """The bytes of the first characters from here on, if they lie in one line."""
    m = PIECE.match(text, start, start + 24)
    return base64.b64decode(m[0].replace("-", "+").replace("_", "/")) if len(m[0]) == 24 else b""


def token_end(text: str) -> int:
    """The length of the signed or encrypted token that a dotted text is, its header an object that names an algorithm, without the dots of a sentence after it; 0 for none.

    Only the signature of the three-part form may be empty, under the algorithm "none".
    """
    parts = text.split(".")

    def parsed(part: str):
        data = decoded(part) if "+" not in part and "/" not in part else None
        try:
            return json.loads(data) if data else None
        except (ValueError, RecursionError):
            return None

    header = parsed(parts[0])
    if not isinstance(header, dict) or not isinstance(header.get("alg"), str):
        return 0
    while parts and not parts[-1]:
        parts.pop()
    if len(parts) == 5:
        return len(".".join(parts)) if isinstance(header.get("enc"), str) and parts[3] else 0
    if len(parts) not in (2, 3) or not isinstance(parsed(parts[1]), dict):
        return 0
    if len(parts) == 2:
        unsigned = len(".".join(parts)) + 1
        return unsigned if header["alg"].lower() == "none" and unsigned <= len(text) else 0
    return len(".".join(parts))


def body_bytes(body: str) -> Iterator[bytes | None]:
    """What a PEM body may decode to: as it stands, and without the marks that code, data files and mail put around its lines.

    Words with a colon or a comma are those of headers.
    """
    plain = lambda words: decoded("".join(x for x in words if ":" not in x and "," not in x))
    yield plain(body.split())
    body = ESCAPED_SIGN.sub(lambda m: chr(int(m[1], 16)) if m[1] else "", ESCAPED_BREAK.sub("\n", body))
    quoted = any(q in body for q in "\"'`")
    words = [x.strip(AROUND) for x in QUOTES.sub("\n", body).split()]
    yield plain(words)
    if quoted:
        # A plus sign beside a quote, or alone, is one of concatenation.
        yield plain(x.strip(AROUND) for x in re.sub(r"""(?<=["'`])\s*\++|(?<!\+)\++\s*(?=["'`])|(?<!\S)\++(?!\S)""", "\n", body).split())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the plain patterns find, kind by kind, leftmost and without overlaps."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def pem_spans(text: str) -> list[tuple[str, int, int]]:
    """PEM blocks of private keys whose bodies decode to one."""
    out = []
    for m in PEM.finditer(text):
        close = text.find("-----", m.end())
        last = f"-----END {m[1]}PRIVATE KEY-----"
        if close < 0 or not text.startswith(last, close):
            continue
        if any(is_key(data) or is_openssh(data) or (m[1] == "ENCRYPTED " and data and elements(data)) for data in body_bytes(text[m.end():close])):
            out.append(("pem", m.start(), close + len(last)))
    return out


def coded_pem_spans(text: str) -> list[tuple[str, int, int]]:
    """Base64 texts that decode to a PEM file with a private key."""
    out, at = [], 0
    while m := PEM_START.search(text, at):
        block = Block.at(text, m.start())
        at = block.end
        plain = block.bytes_from(0)[0].decode("latin-1")
        if keys := pem_spans(plain):
            # Up to the last key and the line break after it; what follows is not part of the secret.
            last = keys[-1][2]
            last += len(plain[last:last + 2]) - len(plain[last:last + 2].lstrip("\r\n"))
            end = block.place(min(len(block.plain), -(-last * 4 // 3)))
            if p := PADDING.match(text, end):
                end = p.end()
            out.append(("pem", m.start(), end))
    return out


def percent_spans(text: str) -> list[tuple[str, int, int]]:
    """Keys written with percent codes, by their places in the text."""
    out = []
    for m in PERCENT_RUN.finditer(text):
        if len(m[0]) < KEY_LEAST:
            continue
        plain = PERCENT.sub(lambda c: chr(int(c[1], 16)), m[0])
        if "PRIVATE" not in plain and not KEY_START.search(plain):
            continue
        # Where the characters after each code lie in the text: every code is two characters longer than what it stands for.
        codes = [c.start() - 2 * k for k, c in enumerate(PERCENT.finditer(m[0]))]
        place = lambda i: m.start() + i + 2 * bisect_left(codes, i)
        out += [(kind, place(a), place(b)) for kind, a, b in [*pem_spans(plain), *key_spans(plain, pem_spans(plain))]]
    return out


def key_spans(text: str, pems: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Keys in bare base64, outside the PEM blocks. A block of lines is decoded once, whatever number of its lines begin like a key."""
    out, inside, at, block = [], [(a, b) for _, a, b in sorted(pems, key=lambda s: s[1])], 0, None
    while m := KEY_START.search(text, at):
        start, at = m.start(), m.end()
        if (k := bisect_right(inside, (start, len(text)))) and start < inside[k - 1][1]:
            at = inside[k - 1][1]
            continue
        first = first_bytes(text, start)
        if first and not outer_fits(first):
            continue
        if block is None or not block.start <= start < block.end:
            block = Block.at(text, start)
        if found := key_at(text, start, block):
            out.append((found[0], start, found[1]))
            at = found[1]
    return out


def hex_spans(text: str) -> list[tuple[str, int, int]]:
    """Keys in hex; their own lengths say where they end."""
    out = []
    for m in HEX_RUN.finditer(text):
        data = bytes.fromhex("".join(HEX_BYTE.findall(m[0][:8 * KEY_MOST])))
        n, known = outer_size(data)
        if known and n <= len(data) and (is_key(data[:n]) or is_openssh(data[:n])):
            end = m.end() if n == len(data) else next(b.end() for k, b in enumerate(HEX_BYTE.finditer(m[0]), 1) if k == n) + m.start()
            out.append(("hexkey", m.start(), end))
    return out


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Encoded candidates whose decoded structure is that of a secret."""
    pems = pem_spans(text) if "PRIVATE KEY-----" in text else []
    out = list(pems)
    if "LS0t" in text:
        out += coded_pem_spans(text)
    out += [("jwt", m.start(), m.start() + size) for m in TOKEN.finditer(text) if (size := token_end(m[0]))]
    out += key_spans(text, pems)
    if "%2" in text:
        taken = [(a, b) for _, a, b in out]
        out += [s for s in percent_spans(text) if not any(a < s[2] and s[1] < b for a, b in taken)]
    return out + hex_spans(text)


def spans(text: str | None) -> list[dict]:
    """All spans of a text by start, then kind; null counts as empty."""
    found = base_spans(text or "") + confirmed_spans(text or "")
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [{"kind": k, "start": a, "end": b} for k, a, b in found]


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, an array of (kind, start, end) in code points, end exclusive.

    Base kinds are reported by pattern alone; ``pem``, ``der``, ``openssh``, ``jwt`` and ``hexkey`` only if the
    decoded bytes parse as a private key or the header and payload as a signed token. A null or empty text
    has no spans; repeated rows give repeated rows; an empty table gives none. Other columns are not read, so
    their names cannot clash. Base64 keys may be wrapped at any width, indented, quoted or a list of strings, may follow or precede other lines
    of base64, and may be written with percent codes; hex may be parted by colons, blanks and line breaks; a PEM file may be base64
    itself. Runs inside the scan, without a shuffle; texts are read whole in time in proportion to their length: a block of base64
    lines is decoded once, and a line that begins like a key costs no more than the bytes of the largest key there can be.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [spans(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, SPANS)], names=["id", "spans"])

    kind = source.schema["id"].dataType.simpleString()
    result = source.mapInArrow(scan, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return result.withColumnRenamed("id", id_column)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as one text."""
    written = lambda column: F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("bigint").alias(f"n_{k}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
