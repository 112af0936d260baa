"""Operators for preparing training data at scale, their queries and SQL. Nothing else imports this."""
