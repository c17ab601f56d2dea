"""Named queries and the SQL each is checked against."""

from . import knowledge, records

#: The registries of the core, in the order in which their queries are listed.
ALL = [records.query, knowledge.query]
