"""Parameters of the registered queries, shared by the Spark jobs and their SQL counterparts."""

from __future__ import annotations

import datetime as dt

ORDER_MONTH = "1997-05-01"
EVENT_MONTH = "2024-01-01"
TICKET_MONTH = "1998-02-01"
PAGE_LIMIT, PAGE_OFFSET = 100, 50
SEARCH_TERM = "r#0000000_2"
EVENTS_SINCE = "2024-01-10 00:00:00"
EVENTS_LIMIT, EVENTS_OFFSET, EVENTS_DEEP = 500, 250, 2_000
SHIFT_ANCHOR = dt.datetime(2025, 6, 30, 18, 45, 10)
# A date with orders and tickets, and one with events.
REFRESH_DAYS = (dt.date(1998, 2, 10), dt.date(2024, 1, 10))
