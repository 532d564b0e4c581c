"""Column expressions. Everything here stays in the JVM unless it says otherwise."""
