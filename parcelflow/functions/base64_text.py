"""Base64 as the message senders write it."""

from __future__ import annotations


def decode(text: str) -> str:
    """SQL for Base64 text to bytes, NULL when it is not Base64.

    Line breaks, blanks, the URL-safe letters and missing padding are accepted.
    Nearly all text is plain Base64; only what fails is tidied and tried again.
    """
    plain = rf"rtrim('=', translate({text}, '-_ \t\r\n', '+/'))"
    padded = f"rpad({plain}, CAST(ceil(length({plain}) / 4) * 4 AS INT), '=')"
    return f"coalesce(try_to_binary({text}, 'base64'), try_to_binary({padded}, 'base64'))"
