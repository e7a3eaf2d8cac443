"""Errors with a code, a context and advice."""

from __future__ import annotations


class EngineError(Exception):
    code = "E000"

    def __init__(self, message: str, suggestion: str | None = None, **context):
        self.message, self.suggestion, self.context = message, suggestion, context
        text = f"[{self.code}] {message}"
        if context:
            text += " (" + ", ".join(f"{k}={v}" for k, v in sorted(context.items())) + ")"
        super().__init__(text + (f"; {suggestion}" if suggestion else ""))

    def to_dict(self) -> dict:
        return {"code": self.code, "type": type(self).__name__, "message": self.message, "suggestion": self.suggestion, "context": self.context}


class ConnectionFailed(EngineError):
    code = "E001"


class AuthError(EngineError):
    code = "E002"


class QueryError(EngineError):
    code = "E003"


class SourceError(EngineError):
    code = "E004"


class SchemaError(EngineError):
    code = "E005"


class RateLimited(EngineError):
    code = "E006"


class PushdownError(EngineError):
    code = "E007"


class ConfigError(EngineError):
    code = "E008"


class TimedOut(EngineError):
    code = "E009"


class EvolutionError(EngineError):
    code = "E010"


_ADVICE = {
    400: (QueryError, "check the query sent"),
    401: (AuthError, "check the credentials"),
    403: (AuthError, "the account lacks the right"),
    404: (SourceError, "check the table and the address"),
    408: (TimedOut, "raise the timeout"),
    429: (RateLimited, "lower the number of partitions"),
    503: (RateLimited, "the service is overloaded"),
}


def of_status(status: int, message: str, **context) -> EngineError:
    """The error for an HTTP status."""
    kind, advice = _ADVICE.get(status, (SourceError if status >= 500 else QueryError, None))
    return kind(message, suggestion=advice, status=status, **context)
