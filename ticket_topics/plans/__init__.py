"""Jobs, registered queries and their SQL counterparts."""
