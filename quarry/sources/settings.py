"""Settings lists, connection strings and options, with what is allowed in each."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Fixed value: what a session starts with.
DEFAULTS = "join_use_nulls 1, group_by_use_nulls 1, final 1"
SERVER_KEYS = ("driver", "host", "port", "dbname", "fetch_size")
USER_KEYS = ("user", "password")
TABLE_KEYS = ("database", "table_name", "engine")
COLUMN_KEYS = ("column_name", "AggregateFunction", "SimpleAggregateFunction", "arrays")
CONNECTION_KEYS = ("host", "port", "dbname", "username", "password")


class SettingsError(ValueError):
    """A list of settings that cannot be read."""


def parse(text: str) -> dict[str, str]:
    """`key value, key 'quoted value'`: commas between, a backslash before a character that stands for itself, the last of equal keys."""
    found: dict[str, str] = {}
    i, n = 0, len(text)

    def blanks() -> None:
        nonlocal i
        while i < n and text[i].isspace():
            i += 1

    def word(what: str) -> str:
        nonlocal i
        out, quoted = [], i < n and text[i] == "'"
        i += quoted
        while i < n:
            c = text[i]
            if c == "\\":
                if i + 1 == n:
                    raise SettingsError("a backslash at the end")
                out.append(text[i + 1])
                i += 2
                continue
            if quoted and c == "'":
                i += 1
                return "".join(out)
            if not quoted and (c.isspace() or c == ","):
                break
            out.append(c)
            i += 1
        if quoted:
            raise SettingsError(f"a quote without its end in the {what}")
        if not out:
            raise SettingsError(f"a missing {what} at {i}")
        return "".join(out)

    blanks()
    while i < n:
        key = word("key")
        if i < n and not text[i].isspace():
            raise SettingsError(f"a missing value for {key!r}")
        blanks()
        found[key] = word("value")
        blanks()
        if i < n:
            if text[i] != ",":
                raise SettingsError(f"a missing comma after {key!r}")
            i += 1
            blanks()
            if i == n:
                raise SettingsError("a comma at the end")
    return found


def connection(text: str) -> dict[str, str]:
    """`host=localhost port=8123`: only known keys."""
    found = {}
    for part in text.split():
        key, mark, value = part.partition("=")
        if not mark:
            raise SettingsError(f"not key=value: {part!r}")
        found |= validated({key: value}, CONNECTION_KEYS, "connection")
    return found


def validated(options: dict[str, str], allowed: tuple[str, ...], of: str) -> dict[str, str]:
    for key in options:
        if key not in allowed:
            raise SettingsError(f"invalid {of} option {key!r}; valid ones are {', '.join(allowed)}")
    return dict(options)


def default_port(driver: str, host: str = "localhost", cloud_suffixes: tuple[str, ...] = ()) -> int:
    """The port of a driver; hosts under a cloud's suffix use the encrypted one."""
    secure = any(host.endswith(s) for s in cloud_suffixes)
    ports = {"http": (8123, 8443), "binary": (9000, 9440)}  # fixed values
    if driver not in ports:
        raise SettingsError(f"invalid driver {driver!r}; valid ones are {', '.join(ports)}")
    return ports[driver][secure]


@dataclass
class Session:
    """Settings that go with every query. Known ones become Spark's, the rest is kept as it is."""

    values: dict[str, str] = field(default_factory=lambda: parse(DEFAULTS))

    #: What Spark calls them.
    KNOWN = {"max_threads": "spark.sql.shuffle.partitions", "session_timezone": "spark.sql.session.timeZone", "max_block_size": "spark.sql.execution.arrow.maxRecordsPerBatch"}

    def set(self, text: str) -> None:
        self.values = parse(text)

    def reset(self) -> None:
        self.values = parse(DEFAULTS)

    def spark_conf(self) -> dict[str, str]:
        return {self.KNOWN[k]: v for k, v in self.values.items() if k in self.KNOWN}

    def apply(self, spark) -> None:
        for key, value in self.spark_conf().items():
            spark.conf.set(key, value)

    @property
    def final(self) -> bool:
        return self.values.get("final", "0") not in ("0", "false")
