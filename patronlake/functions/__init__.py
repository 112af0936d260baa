"""Column expressions. All built-in and code-generated; there is no UDF in this package."""
