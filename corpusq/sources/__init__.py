"""Tables in and out: scans, landing files, overwrites, appends and snapshot changes."""
