"""Generic DataFrame operators.  Every operator takes column *names* for the
key and the event time, so weather readings and the driver's ``events`` table
are two bindings of the same functions."""
