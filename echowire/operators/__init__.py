"""Work on rating rows and on the implied pairs of two id lists."""
