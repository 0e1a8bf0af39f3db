"""Errors after which another try may succeed."""

from __future__ import annotations

import re

#: Classes and codes that Spark, Hadoop and object stores raise for passing faults.
PASSING = (
    r"SocketTimeoutException|SocketException|ConnectException|ConnectTimeoutException|NoRouteToHostException"
    r"|NoHttpResponseException|FetchFailedException|MetadataFetchFailed|ExecutorLostFailure|TaskKilled"
    r"|executor .{0,40}(?:lost|exited)|RpcTimeoutException|HeartbeatReceiver|BlockMissingException"
    r"|\bSlowDown\b|Throttl|TooManyRequests|ServiceUnavailable|RequestTimeout|TimeoutError|TimeoutException"
    r"|ConnectionError|Connection(?:Reset|Refused|Aborted)Error"
)


def described(error: BaseException) -> str:
    """An error with its class, as the ledger keeps it."""
    return f"{type(error).__name__}: {error}"


def is_transient(error: BaseException | str) -> bool:
    if isinstance(error, (TimeoutError, ConnectionError)):
        return True
    return re.search(PASSING, error if isinstance(error, str) else described(error), re.IGNORECASE) is not None
