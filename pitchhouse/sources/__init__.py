"""Sources and sinks: CSV landing, layer table/view writes, and the bridge
from the driver's tables to the match shapes."""
