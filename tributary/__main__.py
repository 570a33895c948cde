from tributary.cli import main

main()
