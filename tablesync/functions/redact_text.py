"""Driver-side redaction for error text (one message, not table data)."""

from __future__ import annotations

import re

from tablesync.functions.clean import DSN_PASSWORD_PATTERN


def _to_python(pattern: str) -> str:
    # Java/RE2 ``\x{hh}`` escapes become Python ``\uhhhh``.
    return re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda m: "\\u" + m.group(1).rjust(4, "0"), pattern)


_DSN = re.compile(_to_python(DSN_PASSWORD_PATTERN))


def redact_text(text: str | None) -> str | None:
    if not text:
        return text
    return _DSN.sub(r"\1***\2", text)
