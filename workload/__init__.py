"""The library run on a generic set of tables (customer, orders, events and so on)."""
