"""Tables in, tables out, and generated load-test tables."""
