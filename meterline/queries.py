"""All queries of the engine by name, and the SQL that says the same."""

from __future__ import annotations

from meterline.plans import archive_lines, archives, corrections, ledgers, payloads, refund_sets, routes, rules, snapshots, stores, streams, usage

QUERIES: dict = {**usage.QUERIES, **ledgers.QUERIES, **archives.QUERIES, **archive_lines.QUERIES, **corrections.QUERIES, **snapshots.QUERIES, **payloads.QUERIES, **routes.QUERIES, **rules.QUERIES, **refund_sets.QUERIES, **stores.QUERIES, **streams.QUERIES}
ORACLE_SQL: dict[str, str] = {**usage.ORACLE_SQL, **ledgers.ORACLE_SQL, **archives.ORACLE_SQL, **archive_lines.ORACLE_SQL, **corrections.ORACLE_SQL, **snapshots.ORACLE_SQL, **payloads.ORACLE_SQL, **routes.ORACLE_SQL, **rules.ORACLE_SQL, **refund_sets.ORACLE_SQL, **stores.ORACLE_SQL, **streams.ORACLE_SQL}
