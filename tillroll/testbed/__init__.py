"""The given benchmark tables as retail data, with a query and a SQL oracle per operator."""
