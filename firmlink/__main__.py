from firmlink.cli import main

main()
