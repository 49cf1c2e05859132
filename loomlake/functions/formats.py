"""Numbers for people, and sizes that people write."""

from __future__ import annotations

import re


def tokens(n: int) -> str:
    """1.23B, 4.5M, 6.7K or the number."""
    for unit, name, digits in ((1e9, "B", 2), (1e6, "M", 1), (1e3, "K", 1)):
        if n >= unit:
            return f"{n / unit:.{digits}f}{name}"
    return str(n)


def duration(seconds: float) -> str:
    """1h02m, 3m04s or 5s; -- for a negative one."""
    if seconds < 0:
        return "--"
    minutes, rest = divmod(int(seconds), 60)
    hours, minutes_left = divmod(minutes, 60)
    return f"{hours}h{minutes_left:02d}m" if hours else f"{minutes}m{rest:02d}s" if minutes else f"{rest}s"


def speed(per_second: float) -> str:
    """Tokens a second."""
    return (f"{per_second:.0f}" if per_second < 1e3 else tokens(per_second)) + " tok/s"


def size(n: float, binary: bool = False) -> str:
    """Bytes in decimal units, KB at least, or in binary ones."""
    if binary:
        for unit in ("B", "KiB", "MiB", "GiB"):
            if n < 1024:
                return f"{n:.1f} {unit}"
            n /= 1024
        return f"{n:.1f} TiB"
    return f"{n / 1e9:.1f} GB" if n >= 1e9 else f"{n / 1e6:.0f} MB" if n >= 1e6 else f"{n / 1e3:.0f} KB"


def parsed_size(text: str) -> int:
    """10g, 5m, 3k or bytes; units are binary."""
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([kmgt]?)b?\s*", text, re.I)
    if not found:
        raise ValueError(f"no size: {text!r}")
    return int(float(found[1]) * 1024 ** " kmgt".index(found[2].lower() or " "))
