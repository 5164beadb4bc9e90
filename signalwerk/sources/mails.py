"""Saved e-mails: the text of all parts that can be read, whatever their encodings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def mail_text(content: Column) -> Column:
    """Text of an e-mail (text or binary): its plain and HTML parts in order, attachments left out, transfer encodings and charsets undone.

    HTML parts come without tags, scripts and styles. Null where sender or date is missing or no part can be read."""

    @F.pandas_udf(StringType())
    def read(mails: pd.Series) -> pd.Series:
        import html
        import re
        from email import message_from_bytes, policy

        hidden, tag = re.compile(r"(?is)<(script|style|noscript)\b.*?</\1\s*>"), re.compile(r"(?s)<[^>]*>")

        def one(raw):
            if raw is None:
                return None
            message = message_from_bytes(bytes(raw), policy=policy.default)
            if not message["From"] or not message["Date"]:
                return None
            said = []
            for part in message.walk():
                kind = part.get_content_type()
                if part.is_multipart() or kind not in ("text/plain", "text/html") or part.get_content_disposition() == "attachment":
                    continue
                try:
                    text = part.get_content()
                except (LookupError, ValueError):  # a charset that nobody knows
                    continue
                said.append(text if kind == "text/plain" else html.unescape(tag.sub(" ", hidden.sub(" ", text))))
            return " ".join(said) if said else None

        return mails.map(one)

    return read(content.cast("binary"))
