"""The registered queries with their plain SQL counterparts."""
