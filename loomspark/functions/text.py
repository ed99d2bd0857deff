"""Column functions on strings: white space, titles, item names, files, media."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the text rules mean it: all of Unicode's, and the separators U+001C to U+001F.
WS = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


#: The same as single characters.
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return strip_ws(F.regexp_replace(c, f"{WS}+", " "))


def norm_heading(c: Column) -> Column:
    return F.replace(F.lower(collapse_ws(c)), F.lit("_"), F.lit(" "))


def looks_like_item_name(c: Column) -> Column:
    """Short, no sentence, no namespace, no media file name. Null is no name."""
    t = collapse_ws(c)
    media = t.rlike(r"(?i)\.(png|jpe?g|gif|webp|svg|ogg|mp3|wav)\b")
    return F.coalesce((t != "") & (F.length(t) <= 40) & ~t.rlike(r"[.!?,]$") & ~t.contains(":") & ~media, F.lit(False))


def is_valid_title(c: Column) -> Column:
    """2 to 100 characters, at most 0.3 of them beyond U+00FF, none Tibetan. Null is not valid."""
    t = strip_ws(c)
    n = F.length(t)
    foreign = F.length(F.regexp_replace(t, r"[\x{0}-\x{FF}]", ""))
    return F.coalesce(n.between(2, 100) & (foreign <= 0.3 * n) & ~t.rlike(r"[\x{F00}-\x{FFF}]"), F.lit(False))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_suffix(path: Column) -> Column:
    """Last suffix in lower case; a leading dot alone makes none."""
    return F.regexp_extract(F.lower(file_name(path)), r"^.+(\.[^.]+)$", 1)


def media_hash(content: Column) -> Column:
    return F.sha2(content, 256)


#: Signatures: offset in bytes, upper-case hex, extension, main type. Fixed values.
SIGNATURES = [
    (0, "89504E470D0A1A0A", "png", "image"),
    (0, "FFD8FF", "jpg", "image"),
    (0, "47494638", "gif", "image"),
    (0, "424D", "bmp", "image"),
    (8, "57454250", "webp", "image"),
    (0, "49492A00", "tif", "image"),
    (0, "4D4D002A", "tif", "image"),
    (0, "494433", "mp3", "audio"),
    (0, "664C6143", "flac", "audio"),
    (0, "4F676753", "ogg", "audio"),
    (8, "57415645", "wav", "audio"),
    (4, "667479704D3441", "m4a", "audio"),
    (4, "66747970", "mp4", "video"),
    (0, "1A45DFA3", "webm", "video"),
    (8, "415649", "avi", "video"),
    (0, "25504446", "pdf", "other_media"),
    (0, "504B0304", "zip", "other_media"),
    (0, "1F8B08", "gz", "other_media"),
]


def _by_signature(content: Column, field: int, default: str) -> Column:
    head = F.hex(F.substring(content, 1, 32))
    out = F.lit(default)
    for at, mark, *names in reversed(SIGNATURES):
        out = F.when(F.substring(head, 2 * at + 1, len(mark)) == mark, F.lit(names[field])).otherwise(out)
    return out


def media_ext(content: Column) -> Column:
    return _by_signature(content, 0, "bin")


def media_type(content: Column) -> Column:
    return _by_signature(content, 1, "other_media")
