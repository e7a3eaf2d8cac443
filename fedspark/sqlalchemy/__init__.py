"""A SQLAlchemy dialect over the DB-API, where SQLAlchemy is installed.

``create_engine("fedspark+servicenow://host?insecure=true")`` attaches the source that the
address names as the database ``source`` (``?database=`` changes that).
"""

from __future__ import annotations

import urllib.parse

from .. import dbapi

try:
    from sqlalchemy.dialects import registry
    from sqlalchemy.engine.default import DefaultDialect
except ImportError:  # the rest of the engine does without it
    DefaultDialect = object
    registry = None

SCHEMES = ("servicenow", "salesforce", "jira", "rest", "file", "csv", "parquet", "json", "excel")


def address(drivername: str, host: str | None, port: int | None, database: str | None, username: str | None, password: str | None, query: dict) -> tuple[str, str, dict]:
    """(address, database name, options) that ``connect`` takes, of the parts of a SQLAlchemy URL."""
    scheme = drivername.partition("+")[2] or "file"
    options = dict(query)
    name = options.pop("database", "source")
    user = "" if username is None else urllib.parse.quote(username, safe="") + ("" if password is None else ":" + urllib.parse.quote(password, safe="")) + "@"
    at = (host or "") + (f":{port}" if port else "")
    return f"{scheme}://{user}{at}/{database or ''}", name, options


class FedsparkDialect(DefaultDialect):
    name = driver = "fedspark"
    paramstyle = default_paramstyle = dbapi.paramstyle
    supports_alter = supports_sane_multi_rowcount = False
    supports_native_boolean = supports_statement_cache = True
    requires_name_normalize = False

    @classmethod
    def import_dbapi(cls):
        return dbapi

    dbapi_module = import_dbapi

    def create_connect_args(self, url):
        uri, name, options = address(url.drivername, url.host, url.port, url.database, url.username, url.password, dict(url.query))
        return [uri], {"name": name, **options}

    def connect(self, *args, **options):
        from ..engine import connect

        return connect(*args, **options)

    def initialize(self, connection):
        """Nothing is asked of the server."""

    def do_rollback(self, connection):
        """Writes are final."""

    def _engine(self, connection):
        return connection.connection.driver_connection.engine

    def get_schema_names(self, connection, **_):
        return sorted(self._engine(connection).attached)

    def get_table_names(self, connection, schema=None, **_):
        engine = self._engine(connection)
        return engine.list_tables(schema or next(iter(engine.attached)))

    def get_view_names(self, connection, schema=None, **_):
        return self._engine(connection).views.list()

    def has_table(self, connection, table_name, schema=None, **_):
        return table_name in self.get_table_names(connection, schema)

    def get_columns(self, connection, table_name, schema=None, **_):
        from sqlalchemy import types

        engine = self._engine(connection)
        kinds = {"string": types.String, "int": types.Integer, "bigint": types.BigInteger, "double": types.Float, "boolean": types.Boolean, "date": types.Date, "timestamp": types.DateTime, "timestamp_ntz": types.DateTime}
        fields = engine.describe(schema or next(iter(engine.attached)), table_name).fields
        return [{"name": f.name, "type": kinds.get(f.dataType.simpleString(), types.String)(), "nullable": f.nullable, "default": None} for f in fields]

    def get_pk_constraint(self, connection, table_name, schema=None, **_):
        return {"constrained_columns": [], "name": None}

    def get_foreign_keys(self, connection, table_name, schema=None, **_):
        return []

    def get_indexes(self, connection, table_name, schema=None, **_):
        return []


if registry is not None:
    for _scheme in SCHEMES:
        registry.register(f"fedspark.{_scheme}", __name__, "FedsparkDialect")
