from lanewise.functions import calendars, clock, labels

__all__ = ["calendars", "clock", "labels"]
