"""Values for test frames."""
import datetime as dt


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text)
