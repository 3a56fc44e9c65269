"""Timecodes ``HH:MM:SS:FF`` and other clock texts; the frame rate is a parameter everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(c: Column, i: int) -> Column:
    return F.get(F.split(F.trim(c), ":"), F.lit(i)).try_cast("double")


def parse_timecode(c: Column, fps: float = 30.0, blank: float | None = 0.0) -> Column:
    """Seconds of a timecode; blank or unreadable text gives ``blank`` (0 or null, by the caller's convention)."""
    seconds = _part(c, 0) * 3600 + _part(c, 1) * 60 + _part(c, 2) + F.coalesce(_part(c, 3), F.lit(0.0)) / fps
    return F.coalesce(seconds, F.lit(blank).cast("double"))


def timecode_frames(c: Column, fps: float = 30.0) -> Column:
    """Whole frames of a timecode, halves to even."""
    return F.bround(parse_timecode(c, fps, None) * fps).cast("long")


def frames_to_timecode(frames: Column, fps: int = 30) -> Column:
    f = F.greatest(frames.cast("long"), F.lit(0).cast("long"))
    total = F.floor(f / fps)
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(total / 3600)), two(F.floor(total / 60) % 60), two(total % 60), two(f % fps))


def format_timecode(seconds: Column, fps: int = 30) -> Column:
    """Whole seconds rounded down, the rest rounded to frames (halves to even) with carry."""
    s = F.greatest(seconds.cast("double"), F.lit(0.0))
    whole = F.floor(s)
    return frames_to_timecode(whole * fps + F.bround((s - whole) * fps).cast("long"), fps)


def seconds_to_timecode(seconds: Column, fps: int = 30) -> Column:
    """All frames rounded at once, halves to even."""
    return frames_to_timecode(F.bround(seconds * fps).cast("long"), fps)


def format_clock(seconds: Column) -> Column:
    """``HH:MM:SS.mmm``, milliseconds rounded."""
    ms = F.bround(F.greatest(seconds.cast("double"), F.lit(0.0)) * 1000).cast("long")
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    return F.concat(F.concat_ws(":", two(F.floor(ms / 3_600_000)), two(F.floor(ms / 60_000) % 60), two(F.floor(ms / 1000) % 60)), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))


def parse_clock(c: Column) -> Column:
    """Seconds of ``HH:MM:SS.mmm`` or ``MM:SS``; null when unreadable."""
    parts = F.transform(F.split(F.trim(c), ":"), lambda x: x.try_cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a * 60 + x)


def parse_name_stamp(c: Column) -> Column:
    """Seconds of a file name that begins ``00h00m01s167ms`` or ``3m07``; null else."""
    full = r"^(\d+)h(\d+)m(\d+)s(\d+)ms"
    short = r"^(\d+)m(\d+)"
    g = lambda p, i: F.regexp_extract(c, p, i).try_cast("double")
    return F.when(c.rlike(full), g(full, 1) * 3600 + g(full, 2) * 60 + g(full, 3) + g(full, 4) / 1000).when(c.rlike(short), g(short, 1) * 60 + g(short, 2))


def loose_range(c: Column) -> Column:
    """First two clock texts in prose (``1:02``, ``1:02:03``, ``1h2m3s``, ``1min02``) as struct (start, end)."""
    token = r"(?:\d+h\d*(?:m\d*)?s?\d*|\d+:\d{2}(?::\d{2})?|\d+ ?min ?\d{0,2})"
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(token), F.lit(0))
    def seconds(t: Column) -> Column:
        nums = F.transform(F.regexp_extract_all(t, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("double"))
        from_left = F.aggregate(nums, F.struct(F.lit(0.0).alias("v"), F.lit(3600.0).alias("u")), lambda a, x: F.struct((a["v"] + x * a["u"]).alias("v"), (a["u"] / 60).alias("u")), lambda a: a["v"])
        from_right = F.aggregate(nums, F.lit(0.0), lambda a, x: a * 60 + x)
        return F.when(t.contains("h"), from_left).when(t.contains("min") & (F.size(nums) == 1), F.get(nums, F.lit(0)) * 60).otherwise(from_right)

    return F.struct(seconds(F.get(found, F.lit(0))).alias("start"), seconds(F.get(found, F.lit(1))).alias("end"))


def row_duration(start: Column, end: Column, default: float = 8.0, least: float = 4.0) -> Column:
    """Length of a row, at least ``least``; ``default`` when either end is unknown."""
    return F.coalesce(F.greatest(end - start, F.lit(least)), F.lit(default))


#: Fixed patterns of times in script texts: ranges or single times in brackets, and bare ranges, open ones too.
_CLOCK = r"\d{1,2}:\d{2}(?::\d{2})?"
_SPOKEN = (
    r"(?:\d+\s*h(?:eure?s?|ours?)?(?:\s*\d+\s*m(?:in(?:utes?)?)?(?:\s*\d+(?:\.\d+)?\s*s(?:ec(?:ondes?|s)?)?)?)?"
    r"|\d+\s*m(?:in(?:utes?)?)?(?:\s*\d+(?:\.\d+)?\s*(?:s(?:ec(?:ondes?|s)?)?)?)?|\d+(?:\.\d+)?\s*s(?:ec(?:ondes?|s)?)?)"
)
_TIME = f"(?:{_CLOCK}|{_SPOKEN})"
BRACKETED_TIMES = rf"(?iU)\s*[(\[]\s*-?{_CLOCK}(?:\s*(?:[-–—]|to|à|a)\s*{_CLOCK})?-?\s*[)\]]"
BARE_TIMES = rf"(?iU)(?<!\w)(?:{_TIME}(?:\s*[-–—]\s*|\s+(?:to\b|à\b)\s*)(?:{_TIME})?-?|-{_TIME}|{_TIME}-)(?!\w)"
#: Fixed hosts whose links make bare times of a block annotations of the video.
VIDEO_HOSTS = ("youtube.com", "youtu.be", "dailymotion.com", "vimeo.com", "twitter.com", "x.com", "facebook.com", "fb.watch", "instagram.com", "tiktok.com", "rumble.com")


def without_times(c: Column, bare: Column) -> Column:
    """A script text without times in brackets, and where ``bare`` holds without bare ranges of times too."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), BRACKETED_TIMES, "")
    return F.trim(F.regexp_replace(F.when(bare, F.regexp_replace(plain, BARE_TIMES, "")).otherwise(plain), r"(?U)\s+", " "))


def links_video(href: Column) -> Column:
    """Whether an address is on one of the video hosts."""
    low = F.lower(F.coalesce(href, F.lit("")))
    out = F.lit(False)
    for host in VIDEO_HOSTS:
        out |= F.contains(low, F.lit(host))
    return out
