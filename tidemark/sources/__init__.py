"""Tables, unions of tables and the views that queries run on."""
