"""Quoting of names and text inside SQL statements."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
