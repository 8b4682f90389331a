"""DataFrame operators: staging, the five analytics models, quality checks, ledger."""
