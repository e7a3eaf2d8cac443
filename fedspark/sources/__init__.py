"""Sources: web APIs, workbooks, files and databases."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .api import KINDS, JiraSource, RestSource, SalesforceSource, ServiceNowSource
from .changes import ChangeSource
from .excel import ExcelSource

#: Scheme names and what they mean.
SCHEMES = {
    "servicenow": "servicenow", "rest": "rest", "http": "rest", "https": "rest", "file": "file", "csv": "file", "parquet": "file", "json": "file", "excel": "file", "xlsx": "file", "xls": "file",
    "salesforce": "salesforce", "sf": "salesforce", "jira": "jira", "atlassian": "jira", "sql": "jdbc", "jdbc": "jdbc", "mysql": "jdbc", "postgresql": "jdbc", "postgres": "jdbc", "mssql": "jdbc",
}


def register(spark: SparkSession) -> None:
    for source in (RestSource, ServiceNowSource, SalesforceSource, JiraSource, ExcelSource, ChangeSource):
        spark.dataSource.register(source)


__all__ = ["KINDS", "SCHEMES", "register"]
