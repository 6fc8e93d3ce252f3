"""The registered queries: one per operator, each with its SQL counterpart."""
