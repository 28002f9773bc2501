"""Small builders shared by the tests."""

from datetime import datetime, timedelta

DAY = datetime(2025, 8, 16)


def at(clock: str) -> datetime:
    """A time on the test day, ``"10:01"`` or ``"10:01:30.5"``."""
    parts = clock.split(":")
    return DAY + timedelta(hours=int(parts[0]), minutes=int(parts[1]), seconds=float(parts[2]) if len(parts) > 2 else 0)


def order(row):
    return [str(value) for value in row]


def rows(df):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=order)


def write_lines(folder, number, *lines):
    """One input file; a number later in time is read in a later batch."""
    import os

    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.txt"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
