"""Training-data operators.  Each module holds one operator; ``registry`` lists their queries."""
