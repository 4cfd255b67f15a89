"""The registered queries: each a Spark callable with its SQL twin."""
