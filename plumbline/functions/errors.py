"""Which failures are worth another try."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column
from pyspark.sql import functions as F

T = TypeVar("T")
#: Codes of errors that a retry can't mend, and messages of such errors.
PERMANENT_CODES = ("6", "26", "27", "38", "41", "53", "69", "72", "117", "130", "467", "490", "491")
TRANSIENT_CODES = ("ECONNRESET", "ECONNREFUSED", "EPIPE", "ETIMEDOUT", "EAI_AGAIN", "ENOTFOUND", "EHOSTUNREACH", "ENETUNREACH", "UND_ERR_SOCKET")
PERMANENT_MESSAGES = "do not know how to serialize|circular structure"


def error_class(code: Column, message: Column) -> Column:
    """permanent or transient; unknown errors are transient."""
    code = F.coalesce(code, F.lit(""))
    said = F.coalesce(message, F.lit("")).rlike(f"(?i){PERMANENT_MESSAGES}")
    return F.when(code.isin(*PERMANENT_CODES) | (~code.isin(*TRANSIENT_CODES) & said), "permanent").otherwise("transient")


def classify(code: object = None, message: str = "") -> str:
    code = "" if code is None else str(code)
    if code in PERMANENT_CODES or code not in TRANSIENT_CODES and re.search(PERMANENT_MESSAGES, message, re.I):
        return "permanent"
    return "transient"


@dataclass(frozen=True)
class Retry:
    """Exponential backoff for driver actions: max_retries + 1 attempts, none after a permanent error."""

    base_ms: int = 1000
    max_ms: int = 30000
    max_retries: int = 5

    def delay_ms(self, attempt: int, jitter: Callable[[], float] = random.random) -> float:
        return min(self.base_ms * 2**attempt, self.max_ms) * (1 + 0.25 * jitter())

    def run(self, action: Callable[[], T], classifier: Callable[[Exception], str] = lambda e: classify(getattr(e, "code", None), str(e)), sleep: Callable[[float], None] = time.sleep) -> T:
        for attempt in range(self.max_retries + 1):
            try:
                return action()
            except Exception as e:
                if attempt == self.max_retries or classifier(e) == "permanent":
                    raise
                sleep(self.delay_ms(attempt) / 1000)
        raise AssertionError("unreachable")
