"""Aircraft-position analytics on PySpark: a bronze / silver / gold lake of state reports."""

from skytracks.session import build_session, pin_utc

__all__ = ["build_session", "pin_utc"]
