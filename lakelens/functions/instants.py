"""Dates and times written as text in filter values, read once when the plan is built."""

from __future__ import annotations

from datetime import datetime, timezone

# Culture-free date forms accepted besides ISO 8601.
_DATE_FORMS = ["%m/%d/%Y", "%Y/%m/%d", "%d %b %Y", "%d %B %Y", "%b %d, %Y", "%B %d, %Y", "%Y-%m"]
_TIME_FORMS = ["", " %H:%M", " %H:%M:%S", " %H:%M:%S.%f", " %I:%M %p", " %I:%M:%S %p"]


def parse_instant(text: str) -> datetime | None:
    """The instant in UTC, without zone; a value that names no offset is taken as UTC."""
    cleaned = text.strip()
    if len(cleaned) < 6 or cleaned.isdigit():
        return None
    moment = None
    try:
        moment = datetime.fromisoformat(cleaned)
    except ValueError:
        for form in (d + t for d in _DATE_FORMS for t in _TIME_FORMS):
            try:
                moment = datetime.strptime(cleaned, form)
                break
            except ValueError:
                continue
    if moment is not None and moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment
